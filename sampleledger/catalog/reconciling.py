"""Reconciliation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.catalog.audits import local, remote
from sampleledger.catalog.inputs import Inputs
from sampleledger.catalog.lookups import prep_edges
from sampleledger.catalog.registry import query
from sampleledger.fixed import TOOLS
from sampleledger.functions import names
from sampleledger.functions.names import with_name_parts
from sampleledger.operators import audit, links, reconcile


def choices(inputs: Inputs) -> DataFrame:
    return reconcile.prep_choices(inputs["fx_biospecimens"], prep_edges(inputs), inputs["fx_seqpreps"])


def resolved(inputs: Inputs) -> DataFrame:
    return reconcile.resolve_samples(with_name_parts(inputs["fx_oldnames"]), choices(inputs))


def merged(inputs: Inputs) -> reconcile.Reconciliation:
    return reconcile.reconcile(local(inputs), remote(inputs))


_MATCHED = "ox_local l JOIN ox_remote_seq r ON r.uid = l.seqprep AND (r.s_well IS NULL OR r.s_well = l.s_well)"


@query("a13_patches", f"""
SELECT r.id, r.uid, l.s_well, r.kneaddata OR l.kneaddata_complete AS kneaddata, r.metaphlan OR l.metaphlan_complete AS metaphlan,
  r.humann OR l.humann_complete AS humann FROM {_MATCHED}
WHERE r.s_well IS NULL OR r.kneaddata OR l.kneaddata_complete OR r.metaphlan OR l.metaphlan_complete OR r.humann OR l.humann_complete""")
def _(inputs):
    return merged(inputs).patches


@query("a14_violations", """
SELECT l.seqprep AS uid, 'well mismatch' AS violation FROM ox_local l JOIN ox_remote_seq r ON r.uid = l.seqprep WHERE r.s_well <> l.s_well""")
def _(inputs):
    return merged(inputs).violations


@query("a14_absent_remotely", """
SELECT seqprep AS uid, 'absent remotely' AS violation FROM ox_local WHERE seqprep NOT IN (SELECT uid FROM ox_remote_seq WHERE kneaddata)
UNION ALL SELECT l.seqprep, 'well mismatch' FROM ox_local l JOIN ox_remote_seq r ON r.uid = l.seqprep WHERE r.kneaddata AND r.s_well <> l.s_well""")
def _(inputs):
    return reconcile.reconcile(local(inputs), remote(inputs).filter("kneaddata")).violations


@query("a14_multiple_entries", """
SELECT l.seqprep AS uid, 'multiple entries' AS violation FROM ox_local l JOIN ox_remote_seq r ON r.uid = l.seqprep""")
def _(inputs):
    return reconcile.reconcile(local(inputs), remote(inputs).unionAll(remote(inputs))).violations


def _alerts(kind: str, have: str, lack: str) -> str:
    return " UNION ALL ".join(
        f"SELECT l.seqprep AS uid, '{t}' AS tool, '{kind}' AS alert FROM {_MATCHED} WHERE {have.format(t)} AND NOT {lack.format(t)}"
        for t in TOOLS
    )


@query("a15_alerts", _alerts("planned update", "l.{}_complete", "r.{}") + " UNION ALL " + _alerts("missing locally", "r.{}", "l.{}_complete"))
def _(inputs):
    return merged(inputs).alerts


@query("j11_resolved_samples", "SELECT path, sample, s_well, seqprep FROM ox_resolved")
def _(inputs):
    return resolved(inputs).select("path", "sample", "s_well", "seqprep")


# A third of the biospecimens are recorded with "-" where their file names have "_".
def known_as(inputs: Inputs) -> DataFrame:
    third = F.right("uid", F.lit(4)).cast("bigint") % 3 == 1
    return inputs["fx_biospecimens"].withColumn(
        "uid", F.when(third, F.replace("uid", F.lit("FG"), F.lit("FG-"))).otherwise(F.col("uid"))
    )


def named_by_well(inputs: Inputs, times: int = 1) -> DataFrame:
    parsed = with_name_parts(inputs["fx_oldnames"]).filter("seqprep IS NOT NULL")
    spelled = F.when(F.right("seqprep", F.lit(4)).cast("bigint") % 3 == 1, F.lit("FG_")).otherwise(F.lit("FG"))
    files = parsed.select(
        F.replace("file", F.lit("FG"), spelled).alias("file"), F.replace("seqprep", F.lit("FG"), spelled).alias("sample")
    ).select(F.concat(F.lit("d/"), "file").alias("path"), "file", "sample", F.lit("d").alias("dir"))
    if times > 1:
        files = files.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(2 ** (times - 1))))).drop("_copy")
    specimens = known_as(inputs)
    preps = reconcile.prep_choices(specimens, prep_edges(inputs), inputs["fx_seqpreps"])
    return reconcile.resolve_by_name_well(files, preps, specimens)


BY_NAME_WELL_SQL = """
SELECT f.path, f.file, f.sample, CASE WHEN h.n = 1 THEN h.uid END AS seqid, CASE WHEN h.n = 1 THEN h.s_well END AS remote_well
FROM ox_named f LEFT JOIN ox_well_hits h ON h.file = f.file AND h.sample = f.sample"""


@query("j12_resolved_by_name_well", BY_NAME_WELL_SQL)
def _(inputs):
    return named_by_well(inputs).select("path", "file", "sample", "seqid", "remote_well")


@query("j12_repeated_paths", f"SELECT path, file, sample, seqid, remote_well FROM ({BY_NAME_WELL_SQL}) n CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2) t")
def _(inputs):
    return named_by_well(inputs, times=2).select("path", "file", "sample", "seqid", "remote_well")


@query("j14_three_way_status", """
SELECT * FROM (
  SELECT r.uid AS seqprep, r.s_well,
    NOT (r.kneaddata = coalesce(l.kneaddata_complete, FALSE) AND r.kneaddata = coalesce(s.kneaddata_complete, FALSE)) AS check_kneaddata,
    NOT (r.metaphlan = coalesce(l.metaphlan_complete, FALSE) AND r.metaphlan = coalesce(s.metaphlan_complete, FALSE)) AS check_metaphlan,
    NOT (r.humann = coalesce(l.humann_complete, FALSE) AND r.humann = coalesce(s.humann_complete, FALSE)) AS check_humann
  FROM ox_remote_seq r LEFT JOIN ox_local l ON l.seqprep = r.uid AND l.s_well = r.s_well
  LEFT JOIN (SELECT seqprep, min(s_well) AS s_well, coalesce(bool_or(suffix = 'kneaddata.log'), FALSE) AS kneaddata_complete,
    coalesce(bool_or(suffix = 'profile.tsv') AND bool_or(suffix = 'bowtie2.tsv') AND bool_or(suffix = '.sam.bz2'), FALSE) AS metaphlan_complete,
    coalesce(bool_or(suffix = 'ecs.tsv') AND bool_or(suffix = 'kos.tsv') AND bool_or(suffix = 'pfams.tsv') AND bool_or(suffix = 'ecs_rename.tsv')
      AND bool_or(suffix = 'kos_rename.tsv') AND bool_or(suffix = 'pfams_rename.tsv'), FALSE) AS humann_complete
  FROM ox_parsed WHERE suffix IS NOT NULL AND size % 7 <> 0 GROUP BY seqprep) s ON s.seqprep = r.uid AND s.s_well = r.s_well WHERE r.s_well IS NOT NULL) AS j
WHERE check_kneaddata OR check_metaphlan OR check_humann""")
def _(inputs):
    stored = with_name_parts(inputs["fx_listing"].filter("size % 7 <> 0")).filter("suffix IS NOT NULL")
    return reconcile.three_way_status(remote(inputs), local(inputs), audit.tool_flags(stored))


# Old ids are spelled with "_" or "-"; one in five of the listed ids is of kind FE.
_OLD_IDS = "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'FG_' ELSE 'FG-' END || CAST(c_custkey AS STRING) AS biospecimen FROM customer WHERE c_custkey % 3 = 0"
_LISTED = """SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'FE_' ELSE 'FG-' END || CAST(o_custkey AS STRING) AS biospecimen, CAST(o_orderkey AS STRING) AS file FROM orders"""


@query("j15_old_version_files", f"""
SELECT file, biospecimen FROM ({_LISTED}) l WHERE biospecimen NOT LIKE 'FE%' AND EXISTS (
  SELECT 1 FROM ({_OLD_IDS}) o WHERE o.biospecimen IN (l.biospecimen, translate(l.biospecimen, '-_', '_-')))""")
def _(inputs):
    key = F.col("c_custkey")
    old = inputs["customer"].filter(key % 3 == 0).select(
        F.concat(F.when(key % 2 == 0, "FG_").otherwise("FG-"), key.cast("string")).alias("biospecimen")
    )
    listed = inputs["orders"].select(
        F.concat(F.when(F.col("o_orderkey") % 5 == 0, "FE_").otherwise("FG-"), F.col("o_custkey").cast("string")).alias("biospecimen"),
        F.col("o_orderkey").cast("string").alias("file"),
    )
    return reconcile.in_old_version_set(listed, old).select("file", "biospecimen")


_LISTED_SAMPLES = """
SELECT DISTINCT b.uid AS biospecimen, p.s_well, p.seqprep AS sample FROM ox_old_parsed p
JOIN fx_seqpreps s ON s.uid = p.seqprep JOIN fx_biospecimens b ON b.id = s.biospecimen_id"""
_PAIR_FILES = """
SELECT DISTINCT b.uid AS biospecimen, s.s_well, b.uid || '_' || s.s_well || '_kneaddata_paired_' || m.mate || '.fastq.gz' AS file
FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id CROSS JOIN (SELECT '1' AS mate UNION ALL SELECT '2') m"""


def pair_files(inputs: Inputs) -> DataFrame:
    lines = choices(inputs).select(F.concat("biospecimen", F.lit("_"), "prep_well", F.lit("_kneaddata_paired")).alias("value"))
    return names.cleaned_pairs(lines)


def listed_samples(inputs: Inputs) -> DataFrame:
    from sampleledger.catalog.links import preps

    listing = with_name_parts(inputs["fx_oldnames"])
    return links.listing_biospecimens(listing, preps(inputs), inputs["fx_biospecimens"]).withColumnRenamed("seqprep", "sample")


ATTACHED_SQL = f"""
SELECT f.file, f.biospecimen, f.s_well, min(l.sample) AS sample FROM ({_PAIR_FILES}) f
JOIN ({_LISTED_SAMPLES}) l ON l.biospecimen = f.biospecimen AND l.s_well = f.s_well GROUP BY f.file, f.biospecimen, f.s_well"""


@query("j16_attached_samples", ATTACHED_SQL)
def _(inputs):
    return reconcile.attach_samples(pair_files(inputs), listed_samples(inputs))
