"""Listing, name and header queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleledger.catalog.registry import query
from sampleledger.fixed import DISK_NAME_PATTERN, STORE_NAME_PATTERN
from sampleledger.functions import names
from sampleledger.operators import lookups
from sampleledger.sources import listings

_PARTS = ", ".join(
    f"NULLIF(regexp_extract({{0}}, '{{1}}', {i}), '') AS {n}" for i, n in enumerate(("seqprep", "s_well", "suffix"), 1)
)

_STORE_ROWS = r"""
SELECT CAST(w[3] AS BIGINT) AS size, 's3://bucket/' || w[4] AS path, w[1] || ' ' || w[2] AS stamp
FROM (SELECT string_split_regex(trim(value), '\s+') AS w FROM fx_store_lines) AS x WHERE len(w) = 4"""


@query("s04_store_listing", f"""
SELECT path, size, regexp_replace(path, '/[^/]*$', '') AS dir, regexp_extract(path, '[^/]*$') AS file,
  CAST(timezone('America/New_York', CAST(stamp AS TIMESTAMP)) AT TIME ZONE 'UTC' AS STRING) AS mod_utc FROM ({_STORE_ROWS}) AS r""")
def _(inputs):
    listing = listings.parse_store_lines(inputs["fx_store_lines"], "bucket")
    zone = F.current_timezone()
    instant = F.convert_timezone(zone, F.lit("UTC"), F.col("mod").cast("timestamp_ntz"))
    return listing.select("path", "size", "dir", "file", F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("mod_utc"))


@query("s05_first_lines", """
SELECT conv_id AS path, min_by(text, turn) AS first_line FROM conversations GROUP BY conv_id""")
def _(inputs):
    return listings.first_of_each(inputs["conversations"], "conv_id", "text", "turn")


@query("s09_matching_lines", r"SELECT value FROM fx_store_lines WHERE regexp_matches(value, 'kneaddata_paired|\s+PRE ')")
def _(inputs):
    return listings.matching_lines(inputs["fx_store_lines"], r"kneaddata_paired|\s+PRE ")


@query("p01_disk_names", "SELECT path, size, seqprep, s_well, suffix FROM ox_parsed")
def _(inputs):
    return names.with_name_parts(inputs["fx_listing"]).select("path", "size", "seqprep", "s_well", "suffix")


# Names with a longer well, a repeated well, a leading word or no rest, besides the usual ones.
_VARIED = """
SELECT CASE size % 6 WHEN 0 THEN 'my ' || file WHEN 1 THEN replace(file, '_S', '_S1') WHEN 2 THEN 'A_S1_' || file
  WHEN 3 THEN regexp_extract(file, '^[^_]*_[^_]*') WHEN 4 THEN replace(file, '_S', '-x_S') ELSE file END AS file FROM fx_files"""


def _varied(inputs):
    size, file = F.col("size") % 6, F.col("file")
    return inputs["fx_files"].select(
        F.when(size == 0, F.concat(F.lit("my "), file))
        .when(size == 1, F.replace(file, F.lit("_S"), F.lit("_S1")))
        .when(size == 2, F.concat(F.lit("A_S1_"), file))
        .when(size == 3, F.regexp_extract(file, "^[^_]*_[^_]*", 0))
        .when(size == 4, F.replace(file, F.lit("_S"), F.lit("-x_S")))
        .otherwise(file)
        .alias("file")
    )


@query("p01_disk_names_varied", f"SELECT file, {_PARTS.format('file', DISK_NAME_PATTERN)} FROM ({_VARIED}) AS v")
def _(inputs):
    return names.with_name_parts(_varied(inputs))


@query("p02_store_names", f"SELECT file, {_PARTS.format('file', STORE_NAME_PATTERN)} FROM ({_VARIED}) AS v")
def _(inputs):
    return names.with_name_parts(_varied(inputs), mode="store")


@query("p03_dir_and_file", """
SELECT DISTINCT url, CASE WHEN contains(url, '/') THEN regexp_replace(url, '/[^/]*$', '') ELSE '' END AS dir, regexp_extract(url, '[^/]*$') AS file FROM pages""")
def _(inputs):
    url = F.col("url")
    return inputs["pages"].select(
        "url", names.dir_of(url).alias("dir"), names.file_of(url).alias("file")
    ).distinct()


@query("p04_tool", """
SELECT path, regexp_extract(dir, '^/data/processed/mgx/?([^/]*)', 1) AS tool FROM fx_files""")
def _(inputs):
    return inputs["fx_files"].select("path", names.tool_of(F.col("dir"), "/data/processed/mgx").alias("tool"))


@query("p05_sequencing_names", "SELECT file, file LIKE 'SEQ%' AS is_seqrecord FROM fx_oldnames")
def _(inputs):
    return inputs["fx_oldnames"].select("file", names.is_sequencing_name(F.col("file")).alias("is_seqrecord"))


_VISITS = """
SELECT visit, CAST(NULLIF(regexp_extract(visit, '^(SDM?)(\\d+)([A-Z])$', 2), '') AS BIGINT) AS subject,
  CASE WHEN regexp_matches(visit, '^SDM?\\d+[A-Z]$') THEN CAST(ascii(right(visit, 1)) - 64 AS INTEGER) END AS timepoint,
  CASE regexp_extract(visit, '^(SDM?)(\\d+)([A-Z])$', 1) WHEN 'SD' THEN 'C' WHEN 'SDM' THEN 'M' END AS mother_child
FROM fx_visit_ids""".replace("\\\\", "\\")


@query("p06_visit_ids", _VISITS)
def _(inputs):
    visits = inputs["fx_visit_ids"].withColumn("v", names.visit_id(F.col("visit")))
    value = F.col("v")
    return visits.select(
        "visit",
        names.subject_of(value).alias("subject"),
        names.timepoint_of(value).alias("timepoint"),
        names.metadata_of(value)["mother_child"].alias("mother_child"),
    )


#: Visit ids with numbers too large and missing ones among them.
_ODD_VISITS = """
SELECT visit FROM fx_visit_ids UNION ALL
SELECT CASE WHEN s_suppkey % 4 <> 0 THEN 'SDM9999999999' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') || 'B' END FROM supplier"""


def _odd_visits(inputs):
    long = F.concat(F.lit("SDM9999999999"), F.lpad(F.col("s_suppkey").cast("string"), 10, "0"), F.lit("B"))
    return inputs["fx_visit_ids"].select("visit").unionAll(inputs["supplier"].select(F.when(F.col("s_suppkey") % 4 != 0, long)))


@query("p06_rejected_visits", rf"""
SELECT visit, CASE WHEN visit IS NULL THEN 'missing' WHEN regexp_matches(visit, '^SDM?\d+[A-Z]$') THEN 'subject' ELSE 'pattern' END AS reason
FROM ({_ODD_VISITS}) AS v WHERE visit IS NULL OR TRY_CAST(NULLIF(regexp_extract(visit, '^(SDM?)(\d+)([A-Z])$', 2), '') AS BIGINT) IS NULL""")
def _(inputs):
    return lookups.rejected_visits(_odd_visits(inputs))


@query("p06_accepted_visits", rf"""
SELECT visit, TRY_CAST(regexp_extract(visit, '^(SDM?)(\d+)([A-Z])$', 2) AS BIGINT) AS subject FROM ({_ODD_VISITS}) AS v
WHERE TRY_CAST(NULLIF(regexp_extract(visit, '^(SDM?)(\d+)([A-Z])$', 2), '') AS BIGINT) IS NOT NULL""")
def _(inputs):
    return lookups.with_visits(_odd_visits(inputs)).select("visit", F.col("visit_id.subject").alias("subject"))


@query("p07_profile_versions", r"""
SELECT path, NULLIF(regexp_extract(first_line, 'mpa_v(\d+)_CHOCOPhlAn', 1), '') AS mpa_v FROM fx_first_lines""")
def _(inputs):
    return inputs["fx_first_lines"].select("path", names.profile_version(F.col("first_line")).alias("mpa_v"))


@query("p07_old_profiles", "SELECT path FROM fx_first_lines WHERE first_line LIKE '%mpa!_v30!_CHOCOPhlAn%' ESCAPE '!'")
def _(inputs):
    return inputs["fx_first_lines"].filter(names.profile_version(F.col("first_line")) == "30").select("path")


@query("p08_database_names", r"""
SELECT path, regexp_replace(first_line, '[#\s]', '', 'g') AS db FROM fx_first_lines WHERE regexp_replace(first_line, '[#\s]', '', 'g') <> ''""")
def _(inputs):
    named = inputs["fx_first_lines"].select("path", names.database_name(F.col("first_line")).alias("db"))
    return named.filter(F.col("db").isNotNull())


@query("p09_cleaned_pairs", r"""
SELECT biospecimen, s_well, biospecimen || '_' || s_well || '_kneaddata_paired_' || mate || '.fastq.gz' AS file FROM (
  SELECT regexp_extract(value, '([\w\-]+)_(S\d+)_kneaddata_paired', 1) AS biospecimen,
    regexp_extract(value, '([\w\-]+)_(S\d+)_kneaddata_paired', 2) AS s_well, unnest(['1', '2']) AS mate
  FROM fx_store_lines WHERE regexp_matches(value, '([\w\-]+)_(S\d+)_kneaddata_paired')) AS x""")
def _(inputs):
    return names.cleaned_pairs(listings.matching_lines(inputs["fx_store_lines"], "kneaddata_paired"))


@query("p11_distinct_prefixes", r"""
SELECT DISTINCT regexp_extract(file, '^(.*?)_S', 1) AS prefix FROM fx_files WHERE file LIKE '%!_S%' ESCAPE '!'""")
def _(inputs):
    return names.distinct_prefixes(inputs["fx_files"], "_S")


@query("p12_replaced_ids", """
SELECT file, replace(file, seqprep, 'NEW' || s_well) AS newfile FROM ox_files WHERE seqprep IS NOT NULL""")
def _(inputs):
    parsed = names.with_name_parts(inputs["fx_files"]).filter("seqprep IS NOT NULL")
    new = F.concat(F.lit("NEW"), "s_well")
    return parsed.select("file", names.replace_id(F.col("file"), F.col("seqprep"), new).alias("newfile"))
