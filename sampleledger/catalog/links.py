"""Link resolution queries and walks from projects to sequencing preps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.base import RecordBase
from sampleledger.catalog.inputs import Inputs
from sampleledger.catalog.lookups import prep_edges
from sampleledger.catalog.registry import query
from sampleledger.functions.names import with_name_parts
from sampleledger.operators import links
from sampleledger.schemas import RECORD_FIELDS
from sampleledger.sources import records


def _links_of(df: DataFrame, column: str, into: str) -> DataFrame:
    """A one-element link array from a foreign key; missing stays missing."""
    return df.withColumn(into, F.when(F.col(column).isNotNull(), F.array(column))).drop(column)


def specimens(inputs: Inputs) -> DataFrame:
    return _links_of(_links_of(inputs["fx_biospecimens"], "subject_id", "subject"), "visit_id", "visit")


def subjects(inputs: Inputs) -> DataFrame:
    return _links_of(inputs["fx_subjects"], "project_id", "project")


def preps(inputs: Inputs) -> DataFrame:
    return _links_of(inputs["fx_seqpreps"], "biospecimen_id", "biospecimen")


def specimens_with_preps(inputs: Inputs) -> DataFrame:
    """Biospecimens with their array of prep ids."""
    arrays = (
        inputs["fx_seqpreps"].groupBy("biospecimen_id")
        .agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "id"))), lambda e: e["id"]).alias("seqprep"))
    )
    return inputs["fx_biospecimens"].select(F.col("id").alias("biospecimen_id"), "uid").join(arrays, "biospecimen_id", "left")


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select("id", F.col("uid").alias(name))


@query("j01_resolve_strict", """
SELECT b.uid, v.uid AS visit FROM fx_biospecimens b LEFT JOIN fx_visits v ON v.id = b.visit_id""")
def _(inputs):
    resolved = links.resolve_strict(specimens(inputs), "visit", _named(inputs["fx_visits"], "visit_uid"), ["uid"])
    return resolved.select("uid", F.col("visit_uid").alias("visit"))


@query("j01_resolve_plain_ids", """
SELECT b.uid, v.uid AS visit FROM fx_biospecimens b LEFT JOIN fx_visits v ON v.id = b.visit_id""")
def _(inputs):
    resolved = links.resolve_strict(inputs["fx_biospecimens"], "visit_id", _named(inputs["fx_visits"], "visit_uid"), ["uid"])
    return resolved.select("uid", F.col("visit_uid").alias("visit"))


@query("j01_multiple_links", """
SELECT b.uid, count(*) AS n_links FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id GROUP BY b.uid HAVING count(*) <> 1""")
def _(inputs):
    several = links.multiple_links(specimens_with_preps(inputs), "seqprep")
    return several.select("uid", F.size("seqprep").cast("bigint").alias("n_links"))


@query("j01_unknown_links", """
SELECT s.uid AS prep, s.biospecimen_id AS child_id FROM fx_seqpreps s
WHERE s.biospecimen_id NOT IN (SELECT id FROM fx_biospecimens WHERE keep = 1)""")
def _(inputs):
    named = inputs["fx_seqpreps"].select(F.col("uid").alias("prep"), F.col("biospecimen_id").alias("child_id"))
    return links.unknown_links(named, inputs["fx_biospecimens"].filter("keep = 1")).select("prep", "child_id")


@query("j02_resolve_first", """
SELECT b.uid, s.uid AS seqprep FROM fx_biospecimens b LEFT JOIN (
  SELECT biospecimen_id, min_by(uid, pos) AS uid FROM fx_seqpreps GROUP BY biospecimen_id) s ON s.biospecimen_id = b.id""")
def _(inputs):
    first = links.resolve_first(specimens_with_preps(inputs), "seqprep", _named(inputs["fx_seqpreps"], "prep_uid"), ["uid"])
    return first.select("uid", F.col("prep_uid").alias("seqprep"))


@query("j03_resolve_flat", """
SELECT b.uid, s.uid AS seqprep, row_number() OVER (PARTITION BY b.uid ORDER BY s.pos) - 1 AS pos
FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id""")
def _(inputs):
    flat = links.resolve_flat(specimens_with_preps(inputs), "seqprep", _named(inputs["fx_seqpreps"], "prep_uid"))
    return flat.select("uid", F.col("prep_uid").alias("seqprep"), F.col("pos").cast("bigint").alias("pos"))


@query("j04_resolve_all", """
SELECT b.uid, s.uid AS seqprep, s.s_well, row_number() OVER (PARTITION BY b.uid ORDER BY s.pos) - 1 AS pos
FROM fx_biospecimens b LEFT JOIN fx_seqpreps s ON s.biospecimen_id = b.id WHERE s.uid IS NOT NULL""")
def _(inputs):
    targets = inputs["fx_seqpreps"].select("id", F.col("uid").alias("seqprep"), "s_well")
    arrays = links.resolve_all(specimens_with_preps(inputs), "seqprep", targets, "uid")
    flat = arrays.select("uid", F.posexplode("linked").alias("pos", "r"))
    return flat.select("uid", "r.seqprep", "r.s_well", F.col("pos").cast("bigint").alias("pos"))


def walk_subjects(inputs: Inputs, project: str | None = None, strict: bool = True) -> DataFrame:
    people = links.with_parents(subjects(inputs), "project")
    return links.project_subjects(inputs["fx_projects"], people, project, strict)


def walk_biospecimens(inputs: Inputs, project: str | None = None, strict: bool = True) -> DataFrame:
    people, samples = links.with_parents(subjects(inputs), "project"), links.with_parents(specimens(inputs), "subject")
    return links.project_biospecimens(inputs["fx_projects"], people, samples, project, strict)


def walk_seqpreps(inputs: Inputs, project: str | None = None, strict: bool = True) -> DataFrame:
    below = links.with_parents(preps(inputs), "biospecimen")
    return links.biospecimen_seqpreps(walk_biospecimens(inputs, project, strict), below, strict)


_SUBJECTS = "fx_projects p JOIN fx_subjects s ON s.project_id = p.id"
_BIOSPECIMENS = f"{_SUBJECTS} JOIN fx_biospecimens b ON b.subject_id = s.id"
_PREPS = f"{_BIOSPECIMENS} JOIN fx_seqpreps q ON q.biospecimen_id = b.id"
_KEPT_B = "b.keep IS DISTINCT FROM 0"


@query("j05_project_subjects", f"SELECT p.uid AS project, s.uid FROM {_SUBJECTS} WHERE p.uid = 'asia' AND s.keep IS DISTINCT FROM 0")
def _(inputs):
    return walk_subjects(inputs, "asia").select("project", "uid")


@query("j06_project_biospecimens", f"SELECT p.uid AS project, s.uid AS subject, b.uid FROM {_BIOSPECIMENS} WHERE p.uid = 'asia' AND {_KEPT_B}")
def _(inputs):
    return walk_biospecimens(inputs, "asia").select("project", "subject", "uid")


@query("j06_biospecimens_all_kept", f"SELECT p.uid AS project, b.uid FROM {_BIOSPECIMENS} WHERE p.uid = 'africa'")
def _(inputs):
    return walk_biospecimens(inputs, "africa", strict=False).select("project", "uid")


@query("j07_project_seqpreps", f"""
SELECT p.uid AS project, b.uid AS biospecimen, q.uid, q.s_well FROM {_PREPS}
WHERE p.uid = 'europe' AND {_KEPT_B} AND q.keep IS DISTINCT FROM 0""")
def _(inputs):
    return walk_seqpreps(inputs, "europe").select("project", "biospecimen", "uid", "s_well")


@query("j08_all_subjects", f"SELECT p.uid AS project, s.uid FROM {_SUBJECTS} WHERE s.keep IS DISTINCT FROM 0")
def _(inputs):
    return walk_subjects(inputs).select("project", "uid")


@query("j08_all_biospecimens", f"SELECT p.uid AS project, b.uid FROM {_BIOSPECIMENS} WHERE {_KEPT_B}")
def _(inputs):
    return walk_biospecimens(inputs).select("project", "uid")


@query("j08_all_seqpreps", f"""
SELECT p.uid AS project, b.uid AS biospecimen, q.uid FROM {_PREPS} WHERE {_KEPT_B} AND q.keep IS DISTINCT FROM 0""")
def _(inputs):
    return walk_seqpreps(inputs).select("project", "biospecimen", "uid")


@query("j08_all_fields", """
SELECT p.uid AS project, s.uid, f.field, f.value FROM (SELECT *, CAST(uid AS BIGINT) AS k FROM fx_subjects) s JOIN fx_projects p ON p.id = s.project_id
JOIN (SELECT uid, 'cohort' AS field, 'group ' || CAST(CAST(uid AS BIGINT) % 7 AS STRING) AS value FROM fx_subjects WHERE CAST(uid AS BIGINT) % 3 = 0
  UNION ALL SELECT uid, 'Note (free)', CASE WHEN CAST(uid AS BIGINT) % 5 = 0 THEN '' ELSE 'see ' END || CAST(CAST(uid AS BIGINT) AS STRING) FROM fx_subjects WHERE CAST(uid AS BIGINT) % 5 < 2
  UNION ALL SELECT uid, 'weight', CAST(CAST(uid AS BIGINT) % 90 AS STRING) || CASE WHEN CAST(uid AS BIGINT) % 2 = 0 THEN '.0' ELSE '.5' END FROM fx_subjects WHERE CAST(uid AS BIGINT) % 2 = 0 OR CAST(uid AS BIGINT) % 7 = 0) f
  ON f.uid = s.uid
WHERE s.keep IS DISTINCT FROM 0""")
def _(inputs):
    people = records.parse_records(inputs["fx_subject_lines"], "Subjects")
    projects = inputs["fx_projects"].withColumns({"tbl": F.lit("Projects"), "fields": F.lit(None).cast("variant")})
    walked = RecordBase({"Projects": projects, "Subjects": people}, all_fields=True).subjects()
    others = [c for c in walked.columns if c not in ("id", "parent_id", "project", *RECORD_FIELDS["Subjects"].fieldNames())]
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in others])
    return walked.select("project", "uid", F.inline(cells)).filter("value IS NOT NULL")


_VISIT_FLAGS = """
SELECT s.uid, coalesce(max(CASE WHEN v.uid = '3mo' THEN 1 ELSE 0 END), 0) AS mo3, coalesce(max(CASE WHEN v.uid = '6mo' THEN 1 ELSE 0 END), 0) AS mo6
FROM fx_subjects s LEFT JOIN fx_biospecimens b ON b.subject_id = s.id LEFT JOIN fx_visits v ON v.id = b.visit_id GROUP BY s.uid"""


def visit_flags(inputs: Inputs) -> DataFrame:
    samples = specimens(inputs)
    return links.visit_flags(
        subjects(inputs).select("id", "uid"), links.back_edges(samples, "subject"),
        links.edges(samples, "visit"), inputs["fx_visits"], {"mo3": "3mo", "mo6": "6mo"},
    ).select("uid", "mo3", "mo6")


@query("j09_visit_flags", _VISIT_FLAGS)
def _(inputs):
    return visit_flags(inputs)


@query("j10_flags_of_ids", f"""
SELECT i.ID, coalesce(f.mo3, 0) AS mo3, coalesce(f.mo6, 0) AS mo6 FROM fx_id_list i LEFT JOIN ({_VISIT_FLAGS}) f ON f.uid = i.ID""")
def _(inputs):
    return links.attach_flags(inputs["fx_id_list"], visit_flags(inputs), "ID", "uid", ["mo3", "mo6"])


# Every third subject has a second row of flags.
_TWICE = f"SELECT * FROM ({_VISIT_FLAGS}) f UNION ALL SELECT uid, 1 AS mo3, 0 AS mo6 FROM fx_subjects WHERE CAST(uid AS BIGINT) % 3 = 0"


def flags_twice(inputs: Inputs) -> DataFrame:
    again = inputs["fx_subjects"].filter("CAST(uid AS BIGINT) % 3 = 0").select("uid", F.lit(1).alias("mo3"), F.lit(0).alias("mo6"))
    return visit_flags(inputs).unionAll(again)


@query("j10_repeated_keys", f"SELECT uid, count(*) AS n_rows FROM ({_TWICE}) t GROUP BY uid HAVING count(*) > 1")
def _(inputs):
    return links.repeated_flag_keys(flags_twice(inputs), "uid")


@query("j10_flags_of_repeated", f"""
SELECT i.ID, coalesce(f.mo3, 0) AS mo3, coalesce(f.mo6, 0) AS mo6 FROM fx_id_list i
LEFT JOIN (SELECT uid, max(mo3) AS mo3, max(mo6) AS mo6 FROM ({_TWICE}) t GROUP BY uid) f ON f.uid = i.ID""")
def _(inputs):
    return links.attach_flags(inputs["fx_id_list"], flags_twice(inputs), "ID", "uid", ["mo3", "mo6"])


@query("j13_rename_map", """
SELECT b.uid AS oldname, s.uid AS seqname FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id""")
def _(inputs):
    return links.rename_map(inputs["fx_biospecimens"], prep_edges(inputs), inputs["fx_seqpreps"])


@query("j17_listing_biospecimens", """
SELECT p.path, p.seqprep, b.uid AS biospecimen FROM ox_old_parsed p LEFT JOIN fx_seqpreps s ON s.uid = p.seqprep
LEFT JOIN fx_biospecimens b ON b.id = s.biospecimen_id""")
def _(inputs):
    listing = with_name_parts(inputs["fx_oldnames"])
    return links.listing_biospecimens(listing, preps(inputs), inputs["fx_biospecimens"]).select("path", "seqprep", "biospecimen")
