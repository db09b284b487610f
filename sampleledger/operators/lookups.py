"""Finding records by table, uid, id, list or pattern.

Records are ``(tbl, id, uid, fields)``. A key that must exist and does not is found by
:func:`missing_keys`; the ``require`` functions raise on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.functions.names import is_record_id, visit_id, visit_reject
from sampleledger.operators.joins import attach, matched


class MissingKey(KeyError):
    """A record that must exist does not."""


class UnknownProject(MissingKey):
    """No project has this name; ``options`` is the table of all projects (uid, id)."""

    def __init__(self, project: str, options: DataFrame):
        super().__init__(f"no project is called {project!r}; see `options` for those there are")
        self.options = options


def by_uid(records: DataFrame, table: str, uid: str) -> DataFrame:
    return records.filter((F.col("tbl") == table) & (F.col("uid") == uid))


def by_id(records: DataFrame, record_id: str) -> DataFrame:
    return records.filter(F.col("id") == record_id)


def require(found: DataFrame, what: str) -> DataFrame:
    """``found`` itself, or an error when it has no row."""
    if found.isEmpty():
        raise MissingKey(what)
    return found


def key_rows(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    """A given list of keys as ``(pos, key)`` rows."""
    return spark.createDataFrame(list(enumerate(keys)), "pos bigint, key string")


def by_keys(records: DataFrame, keys: DataFrame, column: str = "uid") -> DataFrame:
    """The record of each ``(pos, key)`` row, repeats kept; order by ``pos`` for list order.

    An absent key keeps its row with NULL record columns.
    """
    return attach(keys, records.withColumn("_key", F.col(column)), {"key": "_key"}, spread_by=["pos"])


def missing_keys(keys: DataFrame, records: DataFrame, key: str = "key", column: str = "uid") -> DataFrame:
    """Keys that no record has."""
    wanted = keys.select(F.col(key).alias("key")).distinct()
    have = records.select(F.col(column).alias("key")).distinct()
    return wanted.join(have, "key", "left_anti")


def matching_uids(records: DataFrame, pattern: str) -> DataFrame:
    """Records whose uid holds the pattern anywhere."""
    return records.filter(F.rlike(F.col("uid"), F.lit(pattern)))


def having_keys(keys: DataFrame, records: DataFrame, key: str = "key", column: str = "uid") -> DataFrame:
    """Rows of ``keys`` whose key some record has."""
    return matched(keys, records.select(F.col(column).alias(key)).distinct(), key, "left_semi")


def value_or_default(keys: DataFrame, records: DataFrame, value: str, default: Column, column: str = "uid") -> DataFrame:
    """``value`` of each ``(pos, key)`` row's record, or the default."""
    kept = records.select(F.col(column), F.col(value).alias("_value"), F.lit(True).alias("_found"))
    found = attach(keys, kept, {"key": column}, spread_by=["pos"])
    chosen = F.when(F.col("_found"), F.col("_value")).otherwise(default)
    return found.select("pos", "key", chosen.alias(value))


def uids(records: DataFrame, table: str | None = None) -> DataFrame:
    chosen = records if table is None else records.filter(F.col("tbl") == table)
    return chosen.select("uid")


def record_id_flags(values: DataFrame, column: str) -> DataFrame:
    """Values with ``is_record_id``; anything but text of the id shape is false."""
    return values.withColumn("is_record_id", is_record_id(F.col(column).cast("string")))


class InvalidVisit(ValueError):
    """Texts that are no visit ids; ``rejects`` is the table of them."""

    def __init__(self, rejects: DataFrame):
        super().__init__("there are texts that are no visit ids; see `rejects`")
        self.rejects = rejects


def rejected_visits(rows: DataFrame, column: str = "visit") -> DataFrame:
    """Rows whose ``column`` is no visit id, with the ``reason``; it replaces a column of that name."""
    return rows.withColumn("reason", visit_reject(F.col(column))).filter("reason IS NOT NULL")


def with_visits(rows: DataFrame, column: str = "visit", into: str = "visit_id", check: bool = False) -> DataFrame:
    """Rows with the parsed visit id as the struct ``into``, without those of :func:`rejected_visits`;
    with ``check`` any such row is an error, raised now."""
    if check and not (rejects := rejected_visits(rows, column)).isEmpty():
        raise InvalidVisit(rejects)
    return rows.withColumn(into, visit_id(F.col(column))).filter(F.col(into).isNotNull())


def with_field(records: DataFrame, field: str) -> DataFrame:
    """Records that have the field (a column, or a key of ``fields``)."""
    if field in records.columns:
        return records.filter(F.col(field).isNotNull())
    return records.filter(F.array_contains(F.map_keys(F.col("fields").cast("map<string, variant>")), field))


def project_list(projects: DataFrame) -> DataFrame:
    return projects.select("uid", "id")


def invalid_projects(wanted: DataFrame, projects: DataFrame, column: str = "project") -> DataFrame:
    """Wanted project names that are none."""
    return wanted.select(column).distinct().join(projects.select(F.col("uid").alias(column)), column, "left_anti")


def check_project(projects: DataFrame, project: str) -> None:
    """Raise when no project has the name. The error carries the projects there are as a table."""
    if projects.filter(F.col("uid") == project).isEmpty():
        raise UnknownProject(project, project_list(projects))


def all_match(keys: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: does every key hold the pattern (true for no keys)."""
    hit = F.rlike(F.col(column), F.lit(pattern))
    return keys.agg(F.coalesce(F.bool_and(hit), F.lit(True)).alias("all_match"))


def duplicate_uids(records: DataFrame) -> DataFrame:
    """Uids that several records of one table share."""
    return records.groupBy("tbl", "uid").agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)
