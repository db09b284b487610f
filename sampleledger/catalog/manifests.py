"""Sample manifest, stage plan and abundance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleledger.catalog.registry import query
from sampleledger.fixed import EXPECTED_ARTEFACTS, FUNCTION_VERSION_TAG, PROFILE_DATABASE
from sampleledger.plans import abundance, manifests
from sampleledger.sources import abundance_tables

_RAW = r"""
SELECT s.sample, max(f.path) FILTER (WHERE regexp_matches(f.file, '_1\.(fastq|fq)(\.gz)?$', 'i')) AS paired_1,
  max(f.path) FILTER (WHERE regexp_matches(f.file, '_2\.(fastq|fq)(\.gz)?$', 'i')) AS paired_2,
  max(f.path) FILTER (WHERE NOT regexp_matches(f.file, '_[12]\.(fastq|fq)(\.gz)?$', 'i')) AS unpaired,
  count(f.path) FILTER (WHERE regexp_matches(f.file, '_1\.(fastq|fq)(\.gz)?$', 'i')) AS n_1
FROM fx_samples s LEFT JOIN fx_raw f ON regexp_extract(f.file, '^[A-Za-z0-9]*') = s.sample GROUP BY s.sample"""


@query("m01_raw_inputs", f"""
SELECT sample, paired_1, paired_2, unpaired, CASE WHEN n_1 > 1 THEN 'duplicate' WHEN (paired_1 IS NULL) <> (paired_2 IS NULL) THEN 'single_mate'
  WHEN paired_1 IS NULL AND unpaired IS NULL THEN 'none' ELSE 'ok' END AS status FROM ({_RAW}) AS r""")
def _(inputs):
    return manifests.raw_inputs(inputs["fx_raw"], inputs["fx_samples"]).select(
        "sample", *manifests.RAW_ROLES, "status"
    )


@query("m02_pairing", f"""
SELECT sample, paired_1 IS NOT NULL AND paired_2 IS NOT NULL AS has_pair, unpaired IS NOT NULL AS has_orphan FROM ({_RAW}) AS r""")
def _(inputs):
    manifest = manifests.raw_inputs(inputs["fx_raw"], inputs["fx_samples"])
    return manifests.pairing(manifest).select("sample", "has_pair", "has_orphan")


def _role(pattern: str, extra: str = "") -> str:
    return rf"regexp_matches(f.file, '_kneaddata.*{pattern}.*\.(fastq|fq)(\.gz)?$', 'i'){extra}"


_ROLES = {
    "paired_1": _role("paired_1"),
    "paired_2": _role("paired_2"),
    "unmatched_1": _role("unmatched_1"),
    "unmatched_2": _role("unmatched_2"),
    "single": _role("_single", " AND NOT regexp_matches(f.file, '(paired|unmatched)_[12]')"),
}
_CLEANED = f"""
SELECT s.sample, {', '.join(f'max(f.path) FILTER (WHERE {c}) AS {r}, count(f.path) FILTER (WHERE {c}) AS n_{r}' for r, c in _ROLES.items())}
FROM fx_samples s LEFT JOIN fx_cleaned f ON regexp_extract(f.file, '^[A-Za-z0-9]*') = s.sample GROUP BY s.sample"""
_CLEANED_STATUS = f"""
SELECT *, CASE WHEN greatest({', '.join(f'n_{r}' for r in _ROLES)}) > 1 THEN 'duplicate' WHEN (paired_1 IS NULL) <> (paired_2 IS NULL) THEN 'single_mate' ELSE 'ok' END AS status
FROM ({_CLEANED}) AS c"""


@query("m03_cleaned_outputs", f"SELECT sample, {', '.join(_ROLES)}, status FROM ({_CLEANED_STATUS}) AS m")
def _(inputs):
    return manifests.cleaned_outputs(inputs["fx_cleaned"], inputs["fx_samples"]).select(
        "sample", *manifests.CLEANED_ROLES, "status"
    )


@query("m04_concat_plan", f"""
SELECT sample, '/m/' || sample || '.joined.fastq.gz' AS target, concat_ws(' ', {', '.join(_ROLES)}) AS inputs,
  CASE WHEN status <> 'ok' OR coalesce({', '.join(_ROLES)}) IS NULL THEN 'error'
    WHEN sample || '.joined.fastq.gz' IN (SELECT file FROM fx_runs) THEN 'skip' ELSE 'concat' END AS action
FROM ({_CLEANED_STATUS}) AS m""")
def _(inputs):
    cleaned = manifests.cleaned_outputs(inputs["fx_cleaned"], inputs["fx_samples"])
    existing = inputs["fx_runs"].select(F.concat(F.lit("/m/"), "file").alias("path"))
    plan = manifests.concat_plan(cleaned, existing, "/m")
    return plan.withColumn("inputs", F.concat_ws(" ", "inputs"))


@query("m05_cleanup_plan", """
SELECT DISTINCT path FROM fx_cleaned WHERE regexp_matches(file, 'bowtie2|trimmed|repeats')""")
def _(inputs):
    return manifests.cleanup_plan(inputs["fx_cleaned"], inputs["fx_samples"])


@query("m06_compression_plan", """
SELECT DISTINCT f.path FROM fx_cleaned f JOIN fx_samples s ON contains(f.file, s.sample)
WHERE NOT f.file LIKE '%.gz' AND regexp_matches(f.file, s.sample || '.+fastq')""")
def _(inputs):
    return manifests.compression_plan(inputs["fx_cleaned"], inputs["fx_samples"])


_STAGE_FILES = {
    "clean_paired": ("_kneaddata.log",),
    "clean_single": ("_kneaddata_single.log",),
    "concat": (".joined.fastq.gz",),
    "relab_profile": (f"_{PROFILE_DATABASE}_RELAB_profile.tsv", f"_{PROFILE_DATABASE}_bowtie2.tsv"),
    "stats_profile": (f"_{PROFILE_DATABASE}_STATS_profile.tsv",),
    "genefamilies": (f"_{FUNCTION_VERSION_TAG}_2_genefamilies.tsv",),
}


def _exists(endings: tuple[str, ...]) -> str:
    return "(" + " AND ".join(f"sample || '{e}' IN (SELECT file FROM fx_runs)" for e in endings) + ")"


def _stages(rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT sample, '{s}' AS stage, CASE WHEN {rule} THEN 'done' ELSE 'pending' END AS status FROM fx_samples"
        for s, rule in rules.items()
    )


_RULES = {s: _exists(e) for s, e in _STAGE_FILES.items()}
_RULES["concat"] = f"({_RULES['concat']} OR ({_RULES['relab_profile']} AND {_RULES['genefamilies']}))"
_RULES["regroup_rename"] = "FALSE"


@query("m07_stage_plan", _stages(_RULES))
def _(inputs):
    return manifests.stage_plan(inputs["fx_runs"], inputs["fx_samples"])


_DBS = (PROFILE_DATABASE, "mpa_v30_CHOCOPhlAn_201901")


def _rules_of(dbs: tuple[str, ...]) -> dict[str, str]:
    rules = {}
    for stage, endings in _STAGE_FILES.items():
        for db in dbs if stage.endswith("_profile") else ("",):
            rules[f"{stage}:{db}" if db else stage] = _exists(tuple(e.replace(PROFILE_DATABASE, db) if db else e for e in endings))
    profiles = " AND ".join(r for s, r in rules.items() if s.startswith("relab_profile"))
    rules["concat"] = f"({rules['concat']} OR ({profiles} AND {rules['genefamilies']}))"
    return rules | {"regroup_rename": "FALSE"}


@query("m07_stage_plan_two_databases", _stages(_rules_of(_DBS)))
def _(inputs):
    return manifests.stage_plan(inputs["fx_runs"], inputs["fx_samples"], dbs=_DBS)


@query("m07_stage_plan_needed", f"""
SELECT p.sample, p.stage, CASE WHEN p.stage = 'clean_paired' AND NOT (r.paired_1 IS NOT NULL AND r.paired_2 IS NOT NULL) THEN 'not_needed'
  WHEN p.stage = 'clean_single' AND r.unpaired IS NULL THEN 'not_needed' ELSE p.status END AS status
FROM ({_stages(_RULES)}) p JOIN ({_RAW}) r ON r.sample = p.sample""")
def _(inputs):
    raw = manifests.raw_inputs(inputs["fx_raw"], inputs["fx_samples"])
    return manifests.stage_plan(inputs["fx_runs"], inputs["fx_samples"], raw)


_FLAGS = ", ".join(f"{rule} AS {stage}" for stage, rule in _RULES.items())
_LACKS = f"""
SELECT *, CASE WHEN NOT (clean_paired AND clean_single) THEN CASE WHEN NOT ok THEN 'raw' WHEN NOT clean_paired THEN 'clean_paired' ELSE 'clean_single' END END AS no_concat
FROM (SELECT * REPLACE (clean_paired OR ok AND NOT pair AS clean_paired, clean_single OR ok AND NOT orphan AS clean_single), clean_paired AS was_paired, clean_single AS was_single FROM (
  SELECT d.*, r.paired_1 IS NOT NULL AND r.paired_2 IS NOT NULL AS pair, r.unpaired IS NOT NULL AS orphan,
    r.n_1 <= 1 AND (r.paired_1 IS NULL) = (r.paired_2 IS NULL) AND coalesce(r.paired_1, r.unpaired) IS NOT NULL AS ok
  FROM (SELECT sample, {_FLAGS} FROM fx_samples) d JOIN ({_RAW}) r ON r.sample = d.sample) AS x) AS y"""
_NO_PROFILE = "CASE WHEN NOT concat THEN coalesce(no_concat, 'concat') END"
_NO_FAMILIES = f"CASE WHEN NOT concat THEN {_NO_PROFILE} WHEN NOT relab_profile THEN 'relab_profile' END"
_STATES = {
    "clean_paired": ("CASE WHEN ok AND NOT pair THEN 'not_needed' WHEN was_paired THEN 'done' END", "CASE WHEN NOT ok THEN 'raw' END"),
    "clean_single": ("CASE WHEN ok AND NOT orphan THEN 'not_needed' WHEN was_single THEN 'done' END", "CASE WHEN NOT ok THEN 'raw' END"),
    "concat": ("CASE WHEN concat THEN 'done' END", "no_concat"),
    "relab_profile": ("CASE WHEN relab_profile THEN 'done' END", _NO_PROFILE),
    "stats_profile": ("CASE WHEN stats_profile THEN 'done' END", f"CASE WHEN NOT relab_profile THEN coalesce({_NO_PROFILE}, 'relab_profile') END"),
    "genefamilies": ("CASE WHEN genefamilies THEN 'done' END", _NO_FAMILIES),
    "regroup_rename": ("CAST(NULL AS VARCHAR)", f"CASE WHEN NOT genefamilies THEN coalesce({_NO_FAMILIES}, 'genefamilies') END"),
}
_READY = " UNION ALL ".join(
    f"SELECT sample, '{stage}' AS stage, coalesce({over}, CASE WHEN {lack} IS NULL THEN 'ready' ELSE 'blocked' END) AS state, CASE WHEN {over} IS NULL THEN {lack} END AS missing FROM lacks"
    for stage, (over, lack) in _STATES.items()
)


@query("m07_ready_stages", f"SELECT * FROM (WITH lacks AS ({_LACKS}) {_READY}) AS r")
def _(inputs):
    raw = manifests.raw_inputs(inputs["fx_raw"], inputs["fx_samples"])
    return manifests.ready_stages(inputs["fx_runs"], inputs["fx_samples"], raw)


_BEFORE_OLDER = {"profile": "clean", "genefamilies": "profile"} | {f"regroup_{k}": "genefamilies" for k in ("kos", "pfams", "ecs")}
_BEFORE_OLDER |= {f"rename_{k}": f"regroup_{k}" for k in ("kos", "pfams", "ecs")}


def _older_ready() -> str:
    """Each stage of the older pipeline with the last stage before it that leaves a gap."""
    parts = []
    for stage in ["clean", *_BEFORE_OLDER]:
        lack, at = "CAST(NULL AS VARCHAR)", stage
        chain = []
        while at in _BEFORE_OLDER:
            at = _BEFORE_OLDER[at]
            chain.append(at)
        for source in reversed(chain):
            lack = f"CASE WHEN NOT {source} THEN coalesce({lack}, '{source}') END"
        parts.append(
            f"SELECT sample, '{stage}' AS stage, CASE WHEN {stage} THEN 'done' WHEN {lack} IS NULL THEN 'ready' ELSE 'blocked' END AS state, "
            f"CASE WHEN NOT {stage} THEN {lack} END AS missing FROM flags"
        )
    flags = ", ".join(f"{_exists((e,))} AS {s}" for s, e in _OLDER.items())
    return f"SELECT * FROM (WITH flags AS (SELECT sample, {flags} FROM fx_samples) {' UNION ALL '.join(parts)}) AS r"


_OLDER = {"clean": "_kneaddata.log", "profile": "_profile.tsv", "genefamilies": "_genefamilies.tsv"}
_OLDER |= {f"regroup_{k}": f"_{k}.tsv" for k in ("kos", "pfams", "ecs")}
_OLDER |= {f"rename_{k}": f"_{k}_rename.tsv" for k in ("kos", "pfams", "ecs")}


@query("m08_older_ready_stages", _older_ready())
def _(inputs):
    return manifests.older_ready_stages(inputs["fx_runs"], inputs["fx_samples"])


@query("m08_older_stage_plan", _stages({s: _exists((e,)) for s, e in _OLDER.items()}))
def _(inputs):
    return manifests.older_stage_plan(inputs["fx_runs"], inputs["fx_samples"])


@query("m08_older_join_inputs", """
SELECT DISTINCT s.sample, f.path FROM fx_cleaned f JOIN fx_samples s ON contains(f.file, s.sample)
WHERE regexp_matches(f.file, '(paired|unmatched)_[12]') AND s.sample || '_profile.tsv' NOT IN (SELECT file FROM fx_runs)""")
def _(inputs):
    return manifests.older_join_inputs(inputs["fx_cleaned"], inputs["fx_samples"], inputs["fx_runs"])


_MATCHING = "SELECT s.sample, count(f.file) AS n_files FROM fx_samples s LEFT JOIN fx_raw f ON contains(f.file, s.sample) GROUP BY s.sample"


@query("m09_input_pair_errors", f"SELECT * FROM ({_MATCHING}) AS c WHERE n_files <> 2")
def _(inputs):
    return manifests.input_pair_errors(inputs["fx_raw"], inputs["fx_samples"])


def _artefacts() -> str:
    rows = []
    for kind, template in EXPECTED_ARTEFACTS.items():
        for version in (("dbX", "dbY") if "{db}" in template else ("T1",)):
            ending = template.format(sample="", db=version, tag=version)
            rows.append(f"SELECT sample, '{kind}' AS kind, '{version}' AS version, sample || '{ending}' AS file FROM fx_samples")
    return " UNION ALL ".join(rows)


@query("m10_expected_artefacts", _artefacts())
def _(inputs):
    return manifests.expected_artefacts(inputs["fx_samples"], ("dbX", "dbY"), ("T1",))


@query("m11_matching_files", _MATCHING)
def _(inputs):
    return manifests.matching_files(inputs["fx_raw"], inputs["fx_samples"])


@query("m12_table_values", """
SELECT 'd/S' || CAST(p_partkey % 40 AS STRING) || '_genefamilies.tsv' AS file, 'T' || CAST(p_partkey % 40 AS STRING) AS sample,
  'G' || CAST(p_partkey AS STRING) || '|g__a' AS feature, p_partkey + CAST(0.5 AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS database
FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 40 <> 7
UNION ALL SELECT 'd/P' || CAST(p_partkey % 30 AS STRING) || '_profile.tsv', 'P' || CAST(p_partkey % 30 AS STRING), 'k__' || CAST(p_partkey AS STRING), p_partkey % 100 + CAST(0.25 AS DOUBLE), 'db' || CAST(p_partkey % 2 AS STRING) FROM part""")
def _(inputs):
    return abundance_tables.abundances(inputs["fx_table_lines"])


@query("m12_rejected_rows", """
SELECT 'd/S' || CAST(p_partkey % 40 AS STRING) || '_genefamilies.tsv' AS file, 'G' || CAST(p_partkey AS STRING) || '|g__a' || CASE WHEN p_partkey % 11 = 0 THEN ''
    WHEN p_partkey % 13 = 0 THEN chr(9) || 'x' ELSE chr(9) || CAST(p_partkey AS STRING) || '.5' END AS value,
  CASE WHEN p_partkey % 40 = 7 THEN 'header' WHEN p_partkey % 11 = 0 THEN 'cells' ELSE 'value' END AS reason
FROM part WHERE p_partkey % 40 = 7 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0""")
def _(inputs):
    return abundance_tables.rejected_rows(inputs["fx_table_lines"])


_REGROUPED = """
SELECT g.sample, CASE WHEN g.f = 'UNMAPPED' THEN 'UNMAPPED' ELSE coalesce(m.grp, 'UNGROUPED') END AS grp, g.taxon, sum(g.value) AS value
FROM (SELECT sample, split_part(feature, '|', 1) AS f, CASE WHEN contains(feature, '|') THEN split_part(feature, '|', 2) END AS taxon, value FROM fx_genefamilies) g
LEFT JOIN (SELECT DISTINCT feature, grp FROM fx_groups) m ON m.feature = g.f GROUP BY 1, 2, 3"""


@query("m12_regrouped", f"SELECT sample, grp, taxon, round(value, 6) AS value FROM ({_REGROUPED}) AS r")
def _(inputs):
    return abundance.regroup(inputs["fx_genefamilies"], inputs["fx_groups"]).withColumn("value", F.round("value", 6))


@query("m13_named_groups", f"""
SELECT sample, CASE WHEN r.grp IN ('UNMAPPED', 'UNGROUPED', 'UNINTEGRATED') THEN r.grp ELSE r.grp || ': ' || coalesce(n.name, 'NO_NAME') END AS grp,
  taxon, round(value, 6) AS value FROM ({_REGROUPED}) r LEFT JOIN fx_group_names n ON n.grp = r.grp""")
def _(inputs):
    table = abundance.regroup(inputs["fx_genefamilies"], inputs["fx_groups"])
    return abundance.name_groups(table, inputs["fx_group_names"]).withColumn("value", F.round("value", 6))
