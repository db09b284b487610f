"""The record base: all record tables of a snapshot folder, with look-ups and project walks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.operators import audit, links, lookups
from sampleledger.sources import records


@dataclass(frozen=True)
class RecordBase:
    """Record tables by name. Every answer is a lazy DataFrame unless it says it raises.

    ``back_links`` walks the children's short back-reference arrays (``project``, ``subject``,
    ``biospecimen``); without it the parents' link arrays are used, of which a parent with very many
    children has one very long one in one row. With ``all_fields`` walks keep every field that any
    record of a table has, see :func:`sampleledger.sources.records.all_typed`; a walk then reads each
    table's fields when it is built.
    """

    tables: Mapping[str, DataFrame]
    back_links: bool = True
    all_fields: bool = False

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        folder: str,
        fallbacks: Mapping[str, str] | None = None,
        back_links: bool = True,
        fmt: str = "lines",
        all_fields: bool = False,
    ) -> RecordBase:
        return cls(records.read_base(spark, folder, fallbacks, fmt), back_links, all_fields)

    def __getitem__(self, key: str | tuple[str, str]) -> DataFrame:
        """``base[table]``, ``base[table, uid]`` or ``base[record id]``; the last two raise when absent."""
        if isinstance(key, tuple):
            table, uid = key
            return lookups.require(lookups.by_uid(self.tables[table], table, uid), f"{table}: {uid}")
        if key in self.tables:
            return self.tables[key]
        return lookups.require(lookups.by_id(self.records(), key), key)

    def __contains__(self, key: str) -> bool:
        return key in self.tables or not lookups.by_id(self.records(), key).isEmpty()

    def get(self, key: str, default: DataFrame | None = None) -> DataFrame | None:
        return self[key] if key in self else default

    def records(self) -> DataFrame:
        return records.all_records(self.tables)

    def typed(self, table: str) -> DataFrame:
        return (records.all_typed if self.all_fields else records.typed)(self.tables[table], table)

    def uids(self, table: str) -> DataFrame:
        return lookups.uids(self.tables[table])

    def matching(self, table: str, pattern: str) -> DataFrame:
        return lookups.matching_uids(self.tables[table], pattern)

    def many(self, table: str, keys: DataFrame) -> DataFrame:
        """Records of ``(pos, key)`` rows, a key being a uid or a record id; absent keys raise."""
        named = self.tables[table]
        either = named.withColumn("_name", F.explode(F.array("uid", "id")))
        lacking = lookups.missing_keys(keys, either, column="_name")
        if not lacking.isEmpty():
            raise lookups.MissingKey(f"{table}: {lacking.first()['key']}")
        return lookups.by_keys(either, keys, "_name").drop("_name")

    def resolve_links(self, df: DataFrame, column: str, unpack=None, strict: bool = True) -> DataFrame:
        """Linked records of any table, see :func:`sampleledger.operators.links.resolve_links`."""
        targets = self.records().select("id", *[F.col(c).alias(f"linked_{c}") for c in ("tbl", "uid", "fields")])
        return links.resolve_links(df, column, targets, unpack, strict)

    def _children(self, parent: str, field: str, child: str, back: str) -> DataFrame:
        """Records of ``child`` with one row per parent."""
        records_ = self.typed(child)
        if self.back_links:
            return links.with_parents(records_, back)
        return links.with_parents_by_links(links.edges(self.typed(parent), field), records_)

    def _check(self, project: str | None) -> None:
        if project is not None:
            lookups.check_project(self.tables["Projects"], project)

    def subjects(self, project: str | None = None, strict: bool = True) -> DataFrame:
        """Subjects of a project (which must exist), or of every project."""
        self._check(project)
        people = self._children("Projects", "Subjects", "Subjects", "project")
        return links.project_subjects(self.tables["Projects"], people, project, strict)

    def biospecimens(self, project: str | None = None, strict: bool = True) -> DataFrame:
        self._check(project)
        people = self._children("Projects", "Subjects", "Subjects", "project")
        specimens = self._children("Subjects", "Biospecimens", "Biospecimens", "subject")
        return links.project_biospecimens(self.tables["Projects"], people, specimens, project, strict)

    def seqpreps(self, project: str | None = None, strict: bool = True) -> DataFrame:
        preps = self._children("Biospecimens", "seqprep", "SequencingPrep", "biospecimen")
        return links.biospecimen_seqpreps(
            self.biospecimens(project, strict), preps.withColumnRenamed("S_well", "s_well"), strict
        )

    def audit(self, listing: DataFrame, keep: bool = False) -> audit.Audit:
        """Audit of a parsed listing against the sequencing records."""
        preps = self.typed("SequencingPrep").withColumnRenamed("S_well", "s_well")
        return audit.audit_listing(listing, preps, keep=keep)
