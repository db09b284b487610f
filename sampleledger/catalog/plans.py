"""Rename, move, copy and sync plan queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleledger.catalog.lookups import prep_edges
from sampleledger.catalog.reconciling import ATTACHED_SQL, BY_NAME_WELL_SQL, choices, listed_samples, named_by_well, pair_files, resolved
from sampleledger.catalog.registry import query
from sampleledger.functions.names import replace_id, with_name_parts
from sampleledger.operators import links, reconcile
from sampleledger.plans import ordering, renames, sync

_OLD = r"F[EG]\d{12}"
_RENAMED = r"""
SELECT o.oldname, m.newname, o.s_well, o.path, o.dir || '/' || replace(o.file, o.oldname, m.newname) AS newpath FROM (
  SELECT *, regexp_extract(file, '^(F[EG]\d{12})_(S\d+)_', 1) AS oldname FROM ox_old_parsed) o
JOIN (SELECT b.uid AS oldname, min(s.uid) AS newname FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id GROUP BY b.uid) m
  ON m.oldname = o.oldname"""


def new_names(inputs):
    return renames.one_name_each(links.rename_map(inputs["fx_biospecimens"], prep_edges(inputs), inputs["fx_seqpreps"]))


@query("p10_renamed_by_map", _RENAMED)
def _(inputs):
    return renames.renamed_by_map(inputs["fx_oldnames"], new_names(inputs), _OLD)


@query("p10_unnamed_files", r"""
SELECT oldname, path FROM (SELECT *, regexp_extract(file, '^(F[EG]\d{12})_(S\d+)_', 1) AS oldname FROM fx_oldnames) o
WHERE oldname <> '' AND oldname NOT IN (SELECT b.uid FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id)""")
def _(inputs):
    return renames.unnamed_files(inputs["fx_oldnames"], new_names(inputs), _OLD)


@query("r01_rename_unambiguous", f"""
SELECT path, newpath, oldname, s_well, CASE WHEN action = 'rename' AND path <> min(path) FILTER (WHERE action = 'rename') OVER (PARTITION BY newpath) THEN 'clash' ELSE action END AS action
FROM (SELECT r.path, r.newpath, r.oldname, r.s_well, CASE WHEN w.n > 1 THEN 'ambiguous' WHEN r.newpath IN (SELECT path FROM fx_oldnames) THEN 'exists' ELSE 'rename' END AS action
  FROM ({_RENAMED}) r JOIN (SELECT oldname, count(DISTINCT s_well) AS n FROM ({_RENAMED}) i GROUP BY oldname) w ON w.oldname = r.oldname) AS x""")
def _(inputs):
    return renames.rename_unambiguous(renames.renamed_by_map(inputs["fx_oldnames"], new_names(inputs), _OLD), inputs["fx_oldnames"])


_ACTION = """
CASE WHEN seqprep IS NULL THEN 'unresolved' WHEN replace(file, sample, seqprep) IN (SELECT file FROM fx_oldnames WHERE file LIKE 'SEQ%') THEN 'exists' ELSE 'move' END AS action"""
# Every eleventh biospecimen's files stand there under a second spelling too.
_SPELLED_TWICE = """
SELECT file, path, sample, seqprep, dir FROM ox_resolved UNION ALL
SELECT replace(file, 'FG', 'FG-'), replace(path, 'FG', 'FG-'), replace(sample, 'FG', 'FG-'), seqprep, dir FROM ox_resolved
WHERE sample LIKE 'FG%' AND CAST(substr(sample, 3) AS BIGINT) % 11 = 0"""


def spelled_twice(inputs):
    names = ("file", "path", "sample")
    again = F.when(
        F.expr("sample LIKE 'FG%' AND CAST(substr(sample, 3) AS BIGINT) % 11 = 0"),
        F.struct(*[F.replace(c, F.lit("FG"), F.lit("FG-")).alias(c) for c in names]),
    )
    spelled = F.explode(F.array_compact(F.array(F.struct(*names), again))).alias("s")
    return resolved(inputs).select(spelled, "seqprep", "dir").select("s.*", "seqprep", "dir")


def _clashing(plan: str, act: str, columns: str) -> str:
    return f"""SELECT {columns}, CASE WHEN action = '{act}' AND path <> min(path) FILTER (WHERE action = '{act}') OVER (PARTITION BY newpath) THEN 'clash' ELSE action END AS action
FROM ({plan}) AS plan"""


@query("r02_move_old_names", _clashing(f"""
SELECT path, dir || '/' || replace(file, sample, seqprep) AS newpath, {_ACTION} FROM ({_SPELLED_TWICE}) AS t WHERE sample NOT LIKE 'SEQ%'""", "move", "path, newpath"))
def _(inputs):
    return renames.move_old_names(spelled_twice(inputs), inputs["fx_oldnames"])


@query("r03_move_across", _clashing(f"""
SELECT path, 's3://processed/mgx/metaphlan/' || replace(file, sample, seqprep) AS newpath, {_ACTION} FROM ({_SPELLED_TWICE}) AS t WHERE sample NOT LIKE 'SEQ%'""", "move", "path, newpath"))
def _(inputs):
    elsewhere = spelled_twice(inputs).withColumn("dir", F.lit("s3://run/output/old/output/metaphlan"))
    return renames.move_across(elsewhere, inputs["fx_oldnames"], "s3://processed/mgx/")


@query("r04_replace_or_move", _clashing(f"""
SELECT path, 'd/' || replace(file, sample, seqid) AS newpath,
  CASE WHEN replace(file, sample, seqid) IN (SELECT file FROM fx_oldnames) THEN 'remove' ELSE 'move' END AS action
FROM ({BY_NAME_WELL_SQL}) AS n WHERE seqid IS NOT NULL""", "move", "path, newpath"))
def _(inputs):
    return renames.replace_or_move(named_by_well(inputs), inputs["fx_oldnames"])


# Names that become equal when "ab" is taken out; some of the results exist already.
_SPELLED = """
SELECT 'd' AS dir, file, 'd/' || file AS path FROM (
  SELECT 'ab' || CAST(p_partkey AS STRING) AS file FROM part UNION ALL SELECT CAST(p_partkey AS STRING) || 'ab' FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT CAST(p_partkey AS STRING) FROM part WHERE p_partkey % 3 = 0) AS x"""


@query("r05_rename_substring", f"""
SELECT path, newpath, CASE WHEN newpath IN (SELECT path FROM ({_SPELLED}) e) THEN 'exists'
  WHEN row_number() OVER (PARTITION BY newpath ORDER BY file) = 1 THEN 'rename' ELSE 'clash' END AS action FROM (
  SELECT path, file, dir || '/' || replace(file, 'ab', '') AS newpath FROM ({_SPELLED}) s WHERE file LIKE '%ab%') AS x""")
def _(inputs):
    number = F.col("p_partkey").cast("string")
    spelled = F.array_compact(
        F.array(
            F.concat(F.lit("ab"), number),
            F.when(F.col("p_partkey") % 2 == 0, F.concat(number, F.lit("ab"))),
            F.when(F.col("p_partkey") % 3 == 0, number),
        )
    )
    files = inputs["part"].select(F.lit("d").alias("dir"), F.explode(spelled).alias("file"))
    return renames.rename_substring(files.withColumn("path", F.concat(F.lit("d/"), "file")), "ab", "")


@query("r05_ordered_moves", """
WITH RECURSIVE moves AS (SELECT * FROM fx_moves WHERE newpath IS NOT NULL),
files AS (SELECT path FROM fx_moves),
ranked AS (SELECT *, row_number() OVER (PARTITION BY newpath ORDER BY path) AS n FROM moves),
movers AS (SELECT path, newpath FROM ranked WHERE n = 1),
walk AS (
  SELECT path, newpath, newpath AS last, 1 AS step FROM movers
  UNION ALL SELECT w.path, w.newpath, m.newpath, w.step + 1 FROM walk w JOIN movers m ON m.path = w.last WHERE w.last <> w.path AND w.step < 100),
ends AS (SELECT * FROM walk w WHERE NOT EXISTS (SELECT 1 FROM movers m WHERE m.path = w.last) OR w.last = w.path)
SELECT path, newpath, CASE WHEN last = path THEN 'cycle' WHEN last IN (SELECT path FROM files) THEN 'exists' ELSE 'move' END AS action,
  CASE WHEN last <> path AND last NOT IN (SELECT path FROM files) THEN CAST(step AS INT) END AS step FROM ends
UNION ALL SELECT path, newpath, 'clash', NULL FROM ranked WHERE n > 1""")
def _(inputs):
    wanted = inputs["fx_moves"]
    return ordering.order_moves(wanted.filter("newpath IS NOT NULL"), wanted)


@query("r06_ordered_renames", """
WITH RECURSIVE rules AS (SELECT CAST(seq AS BIGINT) AS seq, old_id, replace(new_id, ' ', '') AS new_id FROM fx_ordered_mapping),
walk AS (
  SELECT dir, path, CAST(NULL AS VARCHAR) AS name, file AS newname, CAST(-1 AS BIGINT) AS seq FROM fx_ordered_files
  UNION ALL SELECT w.dir, w.path, w.newname, replace(w.newname, r.old_id, r.new_id), r.seq
  FROM walk w JOIN rules r ON contains(w.newname, r.old_id) AND r.seq = (SELECT min(s.seq) FROM rules s WHERE s.seq > w.seq AND contains(w.newname, s.old_id))),
steps AS (SELECT w.*, r.old_id, r.new_id FROM walk w JOIN rules r ON r.seq = w.seq),
holders AS (SELECT a.dir, a.path, a.newname AS held, a.seq, (SELECT min(b.seq) FROM walk b WHERE b.path = a.path AND b.seq > a.seq) AS until FROM walk a),
conflicts AS (
  SELECT s.dir, min((s.seq, s.name)) AS stop FROM steps s JOIN holders h ON h.dir = s.dir AND h.held = s.newname AND (h.path <> s.path OR s.name = s.newname)
  WHERE h.seq < s.seq AND (h.until IS NULL OR s.seq <= h.until) OR h.seq = s.seq AND h.path < s.path GROUP BY s.dir)
SELECT s.path, s.seq, s.old_id, s.new_id, s.name, s.newname,
  CASE WHEN c.stop IS NULL OR (s.seq, s.name) < c.stop THEN 'rename' WHEN (s.seq, s.name) = c.stop THEN 'conflict' ELSE 'stopped' END AS action
FROM steps s LEFT JOIN conflicts c ON c.dir = s.dir""")
def _(inputs):
    return ordering.rename_in_order(inputs["fx_ordered_files"], inputs["fx_ordered_mapping"])


# A mapping whose ids are of several lengths and contained in one another.
# Every fifteenth new id has a second old one, so that two files get one name.
_MAPPING = """SELECT 'Q' || CAST(p_partkey AS STRING) AS old_id, 'N' || CAST(p_partkey AS STRING) AS new_id FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'R' || CAST(p_partkey AS STRING) AS old_id, 'N' || CAST(p_partkey AS STRING) AS new_id FROM part WHERE p_partkey % 15 = 0"""
_MAPPED_FILES = """
SELECT 'd' AS dir, file, 'd/' || file AS path FROM (
  SELECT 'Q' || CAST(p_partkey AS STRING) || '_a.tsv' AS file FROM part UNION ALL SELECT 'N' || CAST(p_partkey AS STRING) || '_a.tsv' FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT 'R' || CAST(p_partkey AS STRING) || '_a.tsv' FROM part WHERE p_partkey % 15 = 0
  UNION ALL SELECT 'b_Q' || CAST(p_partkey AS STRING) || '_Q' || CAST(p_partkey AS STRING) FROM part) AS x"""


def _mapping(inputs):
    key = F.col("p_partkey").cast("string")
    first = inputs["part"].filter("p_partkey % 3 = 0").select(F.concat(F.lit("Q"), key).alias("old_id"), F.concat(F.lit("N"), key).alias("new_id"))
    second = inputs["part"].filter("p_partkey % 15 = 0").select(F.concat(F.lit("R"), key).alias("old_id"), F.concat(F.lit("N"), key).alias("new_id"))
    return first.unionAll(second)


def _mapped_files(inputs):
    key = F.col("p_partkey").cast("string")
    names = F.array_compact(
        F.array(
            F.concat(F.lit("Q"), key, F.lit("_a.tsv")),
            F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("N"), key, F.lit("_a.tsv"))),
            F.when(F.col("p_partkey") % 15 == 0, F.concat(F.lit("R"), key, F.lit("_a.tsv"))),
            F.concat(F.lit("b_Q"), key, F.lit("_Q"), key),
        )
    )
    return inputs["part"].select(F.explode(names).alias("file")).select(
        F.lit("d").alias("dir"), "file", F.concat(F.lit("d/"), "file").alias("path")
    )


_MAPPED = f"""
SELECT f.path, f.dir, f.file, count(*) AS n_mappings, max_by(m.old_id, (length(m.old_id), m.old_id)) AS old_id,
  max_by(m.new_id, (length(m.old_id), m.old_id)) AS new_id
FROM ({_MAPPED_FILES}) f JOIN ({_MAPPING}) m ON contains(f.file, m.old_id) GROUP BY f.path, f.dir, f.file"""


@query("r06_rename_by_mapping", _clashing(f"""
SELECT path, newpath, old_id, new_id, n_mappings, CASE WHEN newpath IN (SELECT path FROM ({_MAPPED_FILES}) e) THEN 'conflict' ELSE 'rename' END AS action
FROM (SELECT *, dir || '/' || replace(file, old_id, new_id) AS newpath FROM ({_MAPPED}) c) AS d""", "rename", "path, newpath, old_id, new_id, n_mappings"))
def _(inputs):
    return renames.rename_by_mapping(_mapped_files(inputs), _mapping(inputs))


@query("r06_unmatched_ids", """
SELECT old_id FROM fx_mapping m WHERE NOT EXISTS (SELECT 1 FROM fx_oldnames o WHERE substr(o.file, 1, 14) = m.old_id)""")
def _(inputs):
    return renames.unmatched_ids(inputs["fx_oldnames"], inputs["fx_mapping"])


# Profiles of samples whose ids begin one another, and files next to them.
_PREFIXED = "SELECT 'd/SRR' || CAST(p_partkey AS STRING) AS prefix, CASE p_partkey % 3 WHEN 0 THEN 'dbA' ELSE 'dbB' END AS db FROM part WHERE p_partkey % 4 <> 1 AND p_partkey % 10 <> 7"
_NEAR = """
SELECT 'd/SRR' || CAST(p_partkey AS STRING) || '_profile.tsv' AS path FROM part
UNION ALL SELECT 'd/SRR' || CAST(p_partkey AS STRING) || CASE WHEN p_partkey % 5 = 0 THEN '_dbA' ELSE '' END || '.sam' FROM part"""


@query("r07_insert_database", f"""
SELECT path, prefix || '_' || db || substr(path, length(prefix) + 1) AS newpath, db, FALSE AS tied FROM (
  SELECT n.path, max_by(p.prefix, length(p.prefix)) AS prefix, max_by(p.db, length(p.prefix)) AS db
  FROM ({_NEAR}) n JOIN ({_PREFIXED}) p ON starts_with(n.path, p.prefix) GROUP BY n.path) AS b
WHERE NOT contains(path, '_' || db)""")
def _(inputs):
    key = F.col("p_partkey")
    sample = F.concat(F.lit("SRR"), key.cast("string"))
    near = inputs["part"].select(
        F.explode(
            F.array(
                F.concat(F.lit("d/"), sample, F.lit("_profile.tsv")),
                F.concat(F.lit("d/"), sample, F.when(key % 5 == 0, "_dbA").otherwise(""), F.lit(".sam")),
            )
        ).alias("path")
    )
    lines = inputs["part"].filter(key % 4 != 1).select(
        F.lit("d").alias("dir"),
        F.concat(sample, F.lit("_profile.tsv")).alias("file"),
        F.when(key % 10 == 7, "# ").when(key % 3 == 0, "#dbA ").otherwise("# dbB").alias("first_line"),
    )
    return renames.insert_database(near, lines)


@query("r08_copy_page", f"""
SELECT 'in/' || file AS path, 'out/' || newfile AS newpath FROM (
  SELECT file, replace(file, biospecimen, sample) AS newfile, row_number() OVER (ORDER BY file) AS n FROM ({ATTACHED_SQL}) AS a) AS p
WHERE n BETWEEN 51 AND 150""")
def _(inputs):
    files = reconcile.attach_samples(pair_files(inputs), listed_samples(inputs))
    named = files.withColumn("newfile", replace_id(F.col("file"), F.col("biospecimen"), F.col("sample")))
    return renames.copy_page(named, "in/", "out/", 51, 150)


@query("r09_rename_pairs", _clashing("""
SELECT *, CASE WHEN newpath IN (SELECT path FROM fx_oldnames) THEN 'exists' ELSE 'rename' END AS action FROM (
  SELECT o.path, replace(o.path, o.seqprep, s.uid) AS newpath, s.uid AS seqprep FROM ox_old_parsed o
  JOIN fx_biospecimens b ON b.uid = o.seqprep JOIN fx_seqpreps s ON s.biospecimen_id = b.id AND s.s_well = o.s_well) AS x""", "rename", "path, newpath, seqprep"))
def _(inputs):
    pairs = choices(inputs).select(F.col("biospecimen").alias("sample"), F.col("prep_well").alias("s_well"), F.col("prep").alias("seqprep"))
    return renames.rename_pairs(with_name_parts(inputs["fx_oldnames"]), pairs, inputs["fx_oldnames"])


@query("r10_sync_plan", """
SELECT rel, size, reason FROM (
  SELECT CASE WHEN size % 3 = 0 THEN 'copy/data/processed/mgx/' ELSE '' END || substr(path, 21) AS rel, CASE WHEN size % 13 <> 0 THEN size END AS size,
    CASE WHEN size % 5 = 0 THEN 'absent' WHEN size % 13 <> 0 AND size % 7 = 0 THEN 'size' WHEN size % 11 = 0 THEN 'time' END AS reason
  FROM fx_files) AS x WHERE reason IS NOT NULL""")
def _(inputs):
    # the root stands again inside every third path; some sizes are not known on either side
    again = F.when(F.col("size") % 3 == 0, F.lit("/data/processed/mgx/copy")).otherwise("")
    rel = sync.relative_path(F.concat(again, "path"), "/data/processed/mgx")
    size = F.when(F.col("size") % 13 != 0, F.col("size"))
    source = inputs["fx_files"].select(rel.alias("rel"), size.alias("size"), "mod", F.col("size").alias("n"))
    later = F.col("mod") + F.expr("INTERVAL 1 SECOND")
    destination = source.filter("n % 5 <> 0").select(
        "rel",
        F.when(F.col("n") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
        F.when(F.col("n") % 11 == 0, later).otherwise(F.col("mod")).alias("mod"),
    )
    return sync.sync_plan(source.drop("n"), destination)
