"""Record reading and lookup queries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.catalog.inputs import Inputs
from sampleledger.catalog.registry import query
from sampleledger.operators import links, lookups
from sampleledger.sources import records, refresh, tables, versions

_FX = {
    "Aliases": "fx_aliases",
    "Biospecimens": "fx_biospecimens",
    "CollectionBuffer": "fx_buffers",
    "MetabolomicsBatches": "fx_metabolomics_batches",
    "Projects": "fx_projects",
    "SequencingBatches": "fx_sequencing_batches",
    "SequencingPrep": "fx_seqpreps",
    "Sites": "fx_sites",
    "Subjects": "fx_subjects",
    "Visits": "fx_visits",
}


def stored_lines(inputs: Inputs, table: str) -> DataFrame:
    """A record table as the JSON lines of a snapshot."""
    return as_lines(inputs[_FX[table]])


def as_lines(rows: DataFrame) -> DataFrame:
    fields = F.struct(*[F.col(c) for c in rows.columns if c != "id"])
    return rows.select(F.to_json(F.struct("id", fields.alias("fields"))).alias("value"))


def base(inputs: Inputs) -> dict[str, DataFrame]:
    """All record tables, as :func:`records.read_base` makes them of the lines of its files."""
    return records.base_of({t: stored_lines(inputs, t) for t in _FX})


def everything(inputs: Inputs) -> DataFrame:
    return records.all_records(base(inputs))


def wanted_keys(inputs: Inputs) -> DataFrame:
    """Keys to look up: an old-style subject number per order, some unknown."""
    return inputs["orders"].select(
        F.col("o_orderkey").alias("pos"),
        F.lpad((F.col("o_custkey") + F.when(F.col("o_orderkey") % 6 == 0, 10**9).otherwise(0)).cast("string"), 12, "0").alias("key"),
    )


_WANTED = """(SELECT o_orderkey AS pos, lpad(CAST(o_custkey + CASE WHEN o_orderkey % 6 = 0 THEN 1000000000 ELSE 0 END AS STRING), 12, '0') AS key FROM orders)"""


@query("s01_read_records", """
SELECT id, uid, keep, subject_id AS subject FROM fx_biospecimens""")
def _(inputs):
    parsed = base(inputs)["Biospecimens"]
    return parsed.select(
        "id", "uid", F.variant_get("fields", "$.keep", "int").alias("keep"),
        F.variant_get("fields", "$.subject_id", "string").alias("subject"),
    )


@query("s02_read_base", "SELECT tbl, count(*) AS n_records FROM ox_records GROUP BY tbl")
def _(inputs):
    return everything(inputs).groupBy("tbl").agg(F.count(F.lit(1)).alias("n_records"))


@query("s07_id_mapping", r"""
SELECT old_id, regexp_replace(new_id, '\s', '', 'g') AS new_id FROM (
  SELECT c_name AS old_id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ' ' || c_mktsegment || ' x' END AS new_id FROM customer) AS m
WHERE new_id <> ''""")
def _(inputs):
    raw = inputs["customer"].select(
        F.col("c_name").alias("old_id"),
        F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" x"))).alias("new_id"),
    )
    return tables.clean_mapping(raw)


@query("s08_sample_list", "SELECT DISTINCT p_brand AS sample FROM part WHERE p_partkey % 7 <> 0")
def _(inputs):
    lines = inputs["part"].select(
        F.when(F.col("p_partkey") % 7 == 0, " ").otherwise(F.concat(F.lit("  "), "p_brand", F.lit("\t"))).alias("value")
    )
    return tables.sample_list(lines)


_N = "CAST(right(id, 4) AS INT)"


@query("s11_snapshot_changes", f"""
SELECT 'Biospecimens' AS tbl, * FROM (
  SELECT id, 'removed' AS change, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS old_value, CAST(NULL AS VARCHAR) AS new_value FROM fx_biospecimens WHERE {_N} % 7 IN (0, 1)
  UNION ALL SELECT 'recZ' || right(id, 13), 'added', NULL, NULL, NULL FROM fx_biospecimens WHERE {_N} % 7 = 0
  UNION ALL SELECT id, 'changed', 'subject_id', '"' || subject_id || '"', '"' || subject_id || 'x"' FROM fx_biospecimens WHERE {_N} % 7 = 2 AND subject_id IS NOT NULL
  UNION ALL SELECT id, 'changed', 'visit_id', '"' || visit_id || '"', NULL FROM fx_biospecimens WHERE {_N} % 7 = 3 AND visit_id IS NOT NULL
  UNION ALL SELECT id, 'changed', 'keep', CAST(keep AS VARCHAR), CAST(coalesce(keep, 0) + 1 AS VARCHAR) FROM fx_biospecimens WHERE {_N} % 7 = 4
) AS c""")
def _(inputs):
    table = "Biospecimens"
    rows = inputs["fx_biospecimens"]
    n = F.expr(_N) % 7
    newer = rows.filter(n != 1).select(
        F.when(n == 0, F.concat(F.lit("recZ"), F.right("id", F.lit(13)))).otherwise(F.col("id")).alias("id"), "uid",
        F.when(n == 2, F.concat("subject_id", F.lit("x"))).otherwise(F.col("subject_id")).alias("subject_id"),
        F.when(n != 3, F.col("visit_id")).alias("visit_id"),
        F.when(n == 4, F.coalesce("keep", F.lit(0)) + 1).otherwise(F.col("keep")).alias("keep"),
    )
    return versions.snapshot_changes(
        records.parse_records(as_lines(rows), table), records.parse_records(as_lines(newer), table)
    )


_NOW = datetime.datetime(1996, 3, 31)
_POLICY = """
SELECT t.tbl, p.force, CASE WHEN p.tbl IS NULL THEN 1 ELSE p.months END AS months, CASE WHEN p.tbl IS NULL THEN 0 ELSE p.days END AS days
FROM fx_snapshot_tables t LEFT JOIN fx_policies p ON p.tbl = t.tbl"""


@query("s12_stale_snapshots", f"""
SELECT q.tbl, CASE WHEN s.mod IS NULL THEN TRUE WHEN q.force IS NOT NULL THEN q.force
  ELSE s.mod + to_months(CAST(coalesce(q.months, 0) AS INTEGER)) + to_days(CAST(coalesce(q.days, 0) AS INTEGER)) < TIMESTAMP '1996-03-31 00:00:00' END AS "update"
FROM ({_POLICY}) q LEFT JOIN fx_snapshots s ON s.tbl = q.tbl""")
def _(inputs):
    policy = refresh.refresh_policy(inputs["fx_snapshot_tables"], inputs["fx_policies"])
    return refresh.stale_snapshots(policy, inputs["fx_snapshots"], F.lit(_NOW.isoformat(sep=" ")).cast("timestamp_ntz"))


@query("s13_refresh_policy", _POLICY)
def _(inputs):
    return refresh.refresh_policy(inputs["fx_snapshot_tables"], inputs["fx_policies"])


@query("l01_record_by_uid", "SELECT tbl, id, uid FROM ox_records WHERE tbl = 'Subjects' AND uid = '000000000042'")
def _(inputs):
    return lookups.by_uid(everything(inputs), "Subjects", "000000000042").select("tbl", "id", "uid")


@query("l02_record_by_id", "SELECT tbl, id, uid FROM ox_records WHERE id = 'recB0000000000042'")
def _(inputs):
    return lookups.by_id(everything(inputs), "recB0000000000042").select("tbl", "id", "uid")


@query("l03_records_by_keys", f"""
SELECT k.pos, k.key, s.id FROM {_WANTED} k LEFT JOIN fx_subjects s ON s.uid = k.key""")
def _(inputs):
    return lookups.by_keys(inputs["fx_subjects"], wanted_keys(inputs)).select("pos", "key", "id")


@query("l03_missing_keys", f"""
SELECT DISTINCT k.key FROM {_WANTED} k WHERE NOT EXISTS (SELECT 1 FROM fx_subjects s WHERE s.uid = k.key)""")
def _(inputs):
    return lookups.missing_keys(wanted_keys(inputs), inputs["fx_subjects"])


@query("l04_uid_pattern", "SELECT tbl, id, uid FROM ox_records WHERE regexp_matches(uid, '0[13]5$|mo')")
def _(inputs):
    return lookups.matching_uids(everything(inputs), "0[13]5$|mo").select("tbl", "id", "uid")


@query("l05_having_keys", f"""
SELECT k.pos, k.key FROM {_WANTED} k WHERE EXISTS (SELECT 1 FROM fx_subjects s WHERE s.uid = k.key)""")
def _(inputs):
    return lookups.having_keys(wanted_keys(inputs), inputs["fx_subjects"]).select("pos", "key")


@query("l05_value_or_default", f"""
SELECT k.pos, k.key, CASE WHEN s.uid IS NULL THEN -1 ELSE s.keep END AS keep FROM {_WANTED} k LEFT JOIN fx_subjects s ON s.uid = k.key""")
def _(inputs):
    return lookups.value_or_default(wanted_keys(inputs), inputs["fx_subjects"], "keep", F.lit(-1))


@query("l06_uids", "SELECT uid FROM fx_biospecimens")
def _(inputs):
    return lookups.uids(everything(inputs), "Biospecimens")


@query("l07_full_scan", "SELECT tbl, id, uid FROM ox_records")
def _(inputs):
    return everything(inputs).select("tbl", "id", "uid")


@query("l08_is_record_id", """
SELECT text, coalesce(regexp_matches(text, '^rec[A-Za-z0-9]{14}$'), FALSE) AS is_record_id FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'recB' || lpad(CAST(o_orderkey AS STRING), 13, '0') WHEN 1 THEN 'rec' || o_orderstatus
    WHEN 2 THEN NULL ELSE 'recB' || lpad(CAST(o_orderkey AS STRING), 14, '0') END AS text FROM orders) AS x""")
def _(inputs):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("recB"), F.lpad(key.cast("string"), 13, "0")))
        .when(key % 4 == 1, F.concat(F.lit("rec"), "o_orderstatus"))
        .when(key % 4 == 3, F.concat(F.lit("recB"), F.lpad(key.cast("string"), 14, "0")))
    )
    return lookups.record_id_flags(inputs["orders"].select(text.alias("text")), "text")


@query("l09_field_present", "SELECT id, uid FROM fx_biospecimens WHERE visit_id IS NOT NULL")
def _(inputs):
    return lookups.with_field(base(inputs)["Biospecimens"], "visit_id").select("id", "uid")


def _present(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tbl, '{c}' AS field WHERE EXISTS (SELECT 1 FROM {_FX[table]} WHERE {c} IS NOT NULL)"
        for c in columns.split()
    )


@query("l10_field_names", " UNION ALL ".join([
    _present("Projects", "uid"), _present("Subjects", "uid project_id keep"),
    _present("Biospecimens", "uid subject_id visit_id keep"),
    _present("SequencingPrep", "uid biospecimen_id pos s_well keep"), _present("Visits", "uid"),
    *[_present(t, "uid") for t in ("Aliases", "CollectionBuffer", "MetabolomicsBatches", "SequencingBatches", "Sites")]]))
def _(inputs):
    return records.field_names(everything(inputs))


@query("l11_project_list", "SELECT uid, id FROM fx_projects")
def _(inputs):
    return lookups.project_list(inputs["fx_projects"])


@query("l12_invalid_projects", """
SELECT DISTINCT lower(n_name) AS project FROM nation WHERE lower(n_name) NOT IN (SELECT lower(r_name) FROM region)""")
def _(inputs):
    wanted = inputs["nation"].select(F.lower("n_name").alias("project"))
    return lookups.invalid_projects(wanted, inputs["fx_projects"])


@query("l13_all_match", r"""
SELECT bool_and(regexp_matches(b.uid, 'F[EG]\d{12}')) AS all_match FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id""")
def _(inputs):
    keys = links.rename_map(inputs["fx_biospecimens"], prep_edges(inputs), inputs["fx_seqpreps"])
    return lookups.all_match(keys, "oldname", r"F[EG]\d{12}")


def prep_edges(inputs: Inputs) -> DataFrame:
    return inputs["fx_seqpreps"].select(
        F.col("biospecimen_id").alias("parent_id"), "pos", F.col("id").alias("child_id")
    )


@query("l14_duplicate_uids", """
SELECT tbl, uid, count(*) AS n_records FROM (
  SELECT 'Subjects' AS tbl, c_mktsegment AS uid FROM customer UNION ALL SELECT 'Visits', uid FROM fx_visits) AS x
GROUP BY tbl, uid HAVING count(*) > 1""")
def _(inputs):
    segments = inputs["customer"].select(F.lit("Subjects").alias("tbl"), F.col("c_mktsegment").alias("uid"))
    visits = inputs["fx_visits"].select(F.lit("Visits").alias("tbl"), "uid")
    return lookups.duplicate_uids(segments.unionByName(visits))
