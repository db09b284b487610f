"""Inputs derived from the driver tables.

``DERIVED`` holds SQL that means the same in Spark and in the oracle engine. ``ORACLE_ONLY`` holds
further steps that only the oracle takes as SQL: in Spark they are the library's operators.
"""

from __future__ import annotations

import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.fixed import (
    ARTEFACT_FLAGS,
    COMPLETION_RULES,
    DISK_NAME_PATTERN,
    KNOWN_SUFFIXES,
)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

DERIVED = {
    # About 30 files per sample; some unparsable names, samples with two wells, an unknown suffix.
    # The kind of a file picks its suffix and its folder from two lists.
    "fx_listing": """
SELECT file, dir || '/' || file AS path, dir, mod, size FROM (
  SELECT CASE WHEN l_orderkey % 41 = 0 THEN 'README_' || CAST(l_linenumber AS STRING)
    ELSE 'SEQ' || lpad(CAST(l_partkey AS STRING), 10, '0') || '_S' || CAST(1 + (l_partkey + CASE WHEN l_partkey % 11 = 0 AND l_linenumber = 2 THEN 1 ELSE 0 END) % 96 AS STRING)
      || split_part('_kneaddata.log,_profile.tsv,_bowtie2.tsv,.sam.bz2,_genefamilies.tsv,_pathabundance.tsv,_pathcoverage.tsv,_ecs.tsv,_kos.tsv,_pfams.tsv,_ecs_rename.tsv,_kos_rename.tsv,_pfams_rename.tsv,.log,_kneaddata_paired_1.fastq.gz,_old.tmp', ',', kind) END AS file,
    '/data/processed/mgx/' || split_part('kneaddata,metaphlan,metaphlan,metaphlan,humann/main,humann/main,humann/main,humann/main,humann/main,humann/main,humann/main,humann/main,humann/main,humann/main,kneaddata,humann/main', ',', kind) AS dir,
    l_shipdate AS mod, CAST(floor(l_extendedprice) AS BIGINT) AS size
  FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_extendedprice, CAST(1 + (l_orderkey * 7 + l_linenumber) % 16 AS INT) AS kind FROM lineitem) AS x) AS y""",
    # The same listing with one row per path, as a file system has it.
    "fx_files": "SELECT dir, file, path, max(mod) AS mod, max(size) AS size FROM fx_listing GROUP BY dir, file, path",
    # Sequencing records: remote completion status.
    "fx_remote": """
SELECT 'recR' || lpad(CAST(p_partkey AS STRING), 13, '0') AS id,
  'SEQ' || lpad(CAST(p_partkey AS STRING), 10, '0') AS uid,
  CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'S99' ELSE 'S' || CAST(1 + p_partkey % 96 AS STRING) END AS s_well,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'batch' || CAST(p_partkey % 5 AS STRING) END AS sequencing_batch,
  p_size % 2 = 0 AS kneaddata, p_size % 3 = 0 AS metaphlan, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 4 = 0 END AS humann
FROM part""",
    "fx_projects": """
SELECT 'recP' || lpad(CAST(r_regionkey AS STRING), 13, '0') AS id, lower(r_name) AS uid FROM region""",
    "fx_subjects": """
SELECT 'recS' || lpad(CAST(c_custkey AS STRING), 13, '0') AS id, lpad(CAST(c_custkey AS STRING), 12, '0') AS uid,
  'recP' || lpad(CAST(n_regionkey AS STRING), 13, '0') AS project_id,
  CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 8 = 0 THEN NULL ELSE 1 END AS keep
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_biospecimens": """
SELECT 'recB' || lpad(CAST(o_orderkey AS STRING), 13, '0') AS id, 'FG' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS uid,
  CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'recS' || lpad(CAST(o_custkey AS STRING), 13, '0') END AS subject_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'recV' || lpad(CAST(o_orderkey % 5 AS STRING), 13, '0') END AS visit_id,
  CASE WHEN o_orderkey % 10 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL ELSE 1 END AS keep
FROM orders""",
    "fx_aliases": """
SELECT 'recA' || lpad(CAST(s_suppkey AS STRING), 13, '0') AS id, s_name AS uid FROM supplier""",
    "fx_buffers": """
SELECT 'recC' || lpad(CAST(n_nationkey AS STRING), 13, '0') AS id, lower(n_name) AS uid FROM nation""",
    "fx_metabolomics_batches": """
SELECT DISTINCT 'recM' || lpad(CAST(p_size AS STRING), 13, '0') AS id, 'metab' || CAST(p_size AS STRING) AS uid FROM part""",
    "fx_sequencing_batches": """
SELECT DISTINCT 'recN' || lpad(CAST(p_partkey % 5 AS STRING), 13, '0') AS id, 'batch' || CAST(p_partkey % 5 AS STRING) AS uid FROM part""",
    "fx_sites": """
SELECT DISTINCT 'recT' || lpad(CAST(n_regionkey AS STRING), 13, '0') AS id, 'site' || CAST(n_regionkey AS STRING) AS uid FROM nation""",
    "fx_visits": """
SELECT DISTINCT 'recV' || lpad(CAST(o_orderkey % 5 AS STRING), 13, '0') AS id,
  CASE o_orderkey % 5 WHEN 1 THEN '1mo' WHEN 2 THEN '3mo' WHEN 3 THEN '6mo' ELSE '12mo' END AS uid
FROM orders WHERE o_orderkey % 5 <> 0""",
    "fx_seqpreps": """
SELECT 'recQ' || lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 13, '0') AS id,
  'SEQ' || lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 13, '0') AS uid,
  'recB' || lpad(CAST(l_orderkey AS STRING), 13, '0') AS biospecimen_id, CAST(l_linenumber AS BIGINT) AS pos,
  'S' || CAST(1 + (l_orderkey + l_linenumber) % 96 AS STRING) AS s_well,
  CASE WHEN (l_orderkey + l_linenumber) % 12 = 0 THEN 0 ELSE 1 END AS keep
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS d""",
    # Files under old biospecimen names: every 4th unknown, every 5th with a well that fits no prep,
    # every 3rd already renamed (and every 21st under both names).
    "fx_oldnames": """
SELECT file, '/data/processed/mgx/metaphlan' AS dir, '/data/processed/mgx/metaphlan/' || file AS path FROM (
SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'SEQ' || lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 13, '0')
    WHEN l_orderkey % 4 = 0 THEN 'FE' || lpad(CAST(l_orderkey AS STRING), 12, '0')
    ELSE 'FG' || lpad(CAST(l_orderkey AS STRING), 12, '0') END
  || '_S' || CAST(CASE WHEN l_orderkey % 5 = 0 THEN 99 ELSE 1 + (l_orderkey + l_linenumber) % 96 END AS STRING) || '_profile.tsv' AS file
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS d
UNION ALL
SELECT 'SEQ' || lpad(CAST(l_orderkey * 10 + l_linenumber AS STRING), 13, '0') || '_S' || CAST(1 + (l_orderkey + l_linenumber) % 96 AS STRING) || '_profile.tsv' AS file
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS e
WHERE l_orderkey % 7 = 1 AND l_orderkey % 3 <> 0) AS f""",
    "fx_visit_ids": """
SELECT CASE WHEN c_custkey % 10 = 0 THEN lower(v) ELSE v END AS visit FROM (
  SELECT c_custkey, 'SD' || CASE WHEN c_custkey % 2 = 1 THEN 'M' ELSE '' END || lpad(CAST(c_custkey AS STRING), 10, '0') || chr(CAST(65 + c_custkey % 26 AS INT)) AS v FROM customer) AS x""",
    "fx_id_list": """
SELECT CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE '' END || lpad(CAST(c_custkey AS STRING), 12, '0') AS ID FROM customer WHERE c_custkey % 3 = 0""",
    "fx_store_lines": """
SELECT CASE WHEN size % 50 = 0 THEN '                           PRE humann/'
  WHEN size % 51 = 0 THEN CAST(date_trunc('day', mod) AS STRING) || '  12 a key with spaces.tsv'
  ELSE '2023-' || lpad(CAST(1 + size % 12 AS STRING), 2, '0') || '-' || lpad(CAST(1 + size % 28 AS STRING), 2, '0') || ' ' || lpad(CAST(4 + size % 20 AS STRING), 2, '0') || ':05:09 ' || lpad(CAST(size AS STRING), 10, ' ') || ' ' || substr(path, 7) END AS value
FROM fx_files""",
    "fx_mapping": """
SELECT b.uid AS old_id, min(s.uid) AS new_id FROM fx_biospecimens AS b JOIN fx_seqpreps AS s ON s.biospecimen_id = b.id GROUP BY b.uid""",
    # Subjects as record lines. Fields that no schema names: one in every third record, one that is a
    # number or text, one that is a number of either kind.
    "fx_subject_lines": """
SELECT '{"id":"' || s.id || '","fields":{"uid":"' || s.uid || '","project":["' || s.project_id || '"]'
  || CASE WHEN s.keep IS NULL THEN '' ELSE ',"keep":' || CAST(s.keep AS STRING) END
  || CASE WHEN k % 3 = 0 THEN ',"cohort":"group ' || CAST(k % 7 AS STRING) || '"' ELSE '' END
  || CASE WHEN k % 5 = 0 THEN ',"Note (free)":' || CAST(k AS STRING) WHEN k % 5 = 1 THEN ',"Note (free)":"see ' || CAST(k AS STRING) || '"' ELSE '' END
  || CASE WHEN k % 2 = 0 THEN ',"weight":' || CAST(k % 90 AS STRING) WHEN k % 7 = 0 THEN ',"weight":' || CAST(k % 90 AS STRING) || '.5' ELSE '' END || '}}' AS value
FROM (SELECT *, CAST(uid AS BIGINT) AS k FROM fx_subjects) AS s""",
    # Lines of functional tables and profiles, several files of each; one file has no header, some
    # rows lack a cell or have a word for a number.
    "fx_table_lines": """
SELECT 'd/S' || CAST(p_partkey % 40 AS STRING) || '_genefamilies.tsv' AS file, 'G' || CAST(p_partkey AS STRING) || '|g__a' || CASE WHEN p_partkey % 11 = 0 THEN ''
  WHEN p_partkey % 13 = 0 THEN chr(9) || 'x' ELSE chr(9) || CAST(p_partkey AS STRING) || '.5' END AS value FROM part
UNION ALL SELECT DISTINCT 'd/S' || CAST(p_partkey % 40 AS STRING) || '_genefamilies.tsv', '# Gene Family' || chr(9) || 'T' || CAST(p_partkey % 40 AS STRING) || '_Abundance-RPKs' FROM part WHERE p_partkey % 40 <> 7
UNION ALL SELECT 'd/P' || CAST(p_partkey % 30 AS STRING) || '_profile.tsv', 'k__' || CAST(p_partkey AS STRING) || chr(9) || '2' || chr(9) || CAST(p_partkey % 100 AS STRING) || '.25' || CASE WHEN p_partkey % 3 = 0 THEN chr(9) ELSE '' END FROM part
UNION ALL SELECT DISTINCT 'd/P' || CAST(p_partkey % 30 AS STRING) || '_profile.tsv', '#clade_name' || chr(9) || 'NCBI_tax_id' || chr(9) || 'relative_abundance' || chr(9) || 'additional_species' FROM part
UNION ALL SELECT DISTINCT 'd/P' || CAST(p_partkey % 30 AS STRING) || '_profile.tsv', '#db' || CAST(p_partkey % 2 AS STRING) FROM part
UNION ALL SELECT DISTINCT 'd/P' || CAST(p_partkey % 30 AS STRING) || '_profile.tsv', '#/bin/run --in x.fq' FROM part""",
    # Twenty files at a time: a chain of moves that ends at a free name, a cycle, a chain up to a file
    # that stays, and pairs that want one name.
    "fx_moves": """
SELECT 'd/' || CAST(k AS STRING) AS path, CASE
  WHEN b % 4 = 0 THEN 'd/' || CASE WHEN r < 19 THEN '' ELSE 'x' END || CAST(k + 1 AS STRING)
  WHEN b % 4 = 1 THEN 'd/' || CAST(CASE WHEN r < 19 THEN k + 1 ELSE k - 19 END AS STRING)
  WHEN b % 4 = 2 AND r < 12 THEN 'd/' || CAST(k + 1 AS STRING)
  WHEN b % 4 = 3 THEN 'd/y' || CAST(k - k % 2 AS STRING) END AS newpath
FROM (SELECT p_partkey AS k, p_partkey % 20 AS r, CAST(floor(p_partkey / 20) AS BIGINT) AS b FROM part) AS p""",
    # Mappings whose new ids are old ids of later ones, in forty folders; in some a renamed file ends
    # where another has arrived before.
    "fx_ordered_mapping": """
SELECT p_partkey AS seq, 'A' || CAST(p_partkey AS STRING) || '_' AS old_id, 'B' || CAST(p_partkey AS STRING) || '_' AS new_id FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 100000000000 + p_partkey, 'B' || CAST(p_partkey AS STRING) || '_', 'C' || CAST(p_partkey AS STRING) || '_' FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 300000000000 - p_partkey, 'Z' || CAST(p_partkey AS STRING) || '_', 'C ' || CAST(p_partkey AS STRING) || '_' FROM part WHERE p_partkey % 36 = 0
UNION ALL SELECT 400000000000 + p_partkey, 'Z' || CAST(p_partkey AS STRING) || '_', 'A' || CAST(p_partkey AS STRING) || '_' FROM part WHERE p_partkey % 9 = 0""",
    "fx_ordered_files": """
SELECT dir, file, dir || '/' || file AS path FROM (
  SELECT 'd' || CAST(p_partkey % 40 AS STRING) AS dir, 'A' || CAST(p_partkey AS STRING) || '_' || CAST(p_size AS STRING) || '.tsv' AS file FROM part
  UNION ALL SELECT 'd' || CAST(p_partkey % 40 AS STRING), 'Z' || CAST(p_partkey AS STRING) || '_' || CAST(p_size AS STRING) || '.tsv' FROM part WHERE p_partkey % 3 = 0) AS x""",
    # Raw reads with missing mates, orphans and doubled mates; SRR1 is a prefix of SRR10.
    "fx_samples": "SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample FROM part",
    "fx_raw": """
SELECT sample || ending AS file, '/data/rawfastq/' || sample || ending AS path FROM (
SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_1.fastq.gz' AS ending FROM part WHERE p_partkey % 25 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_1.fq' AS ending FROM part WHERE p_partkey % 15 = 0 AND p_partkey % 25 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_2.FASTQ.gz' AS ending FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 25 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '.fastq' AS ending FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 25 <> 0
) AS x""",
    "fx_cleaned": """
SELECT sample || '_kneaddata' || ending AS file, '/data/kneaddata/' || sample || '_kneaddata' || ending AS path FROM (
SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_paired_1.fastq.gz' AS ending FROM part WHERE p_partkey % 25 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_paired_2.fastq.gz' AS ending FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 25 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_unmatched_1.fastq' AS ending FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_unmatched_2.fastq' AS ending FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_hg37_bowtie2_unmatched_1_contam.fastq.gz' AS ending FROM part WHERE p_partkey % 12 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_single.fastq.gz' AS ending FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '.trimmed.repeats.1.fastq' AS ending FROM part WHERE p_partkey % 6 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '.log' AS ending FROM part WHERE p_partkey % 2 = 0
) AS x""",
    # Marker files of runs, current and older names.
    "fx_runs": """
SELECT sample || ending AS file FROM (
SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_kneaddata.log' AS ending FROM part WHERE p_partkey % 11 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_kneaddata_single.log' AS ending FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '.joined.fastq.gz' AS ending FROM part WHERE p_partkey % 7 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_vOct22_CHOCOPhlAnSGB_202403_RELAB_profile.tsv' AS ending FROM part WHERE p_partkey % 6 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_vOct22_CHOCOPhlAnSGB_202403_bowtie2.tsv' AS ending FROM part WHERE p_partkey % 5 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_vOct22_CHOCOPhlAnSGB_202403_STATS_profile.tsv' AS ending FROM part WHERE p_partkey % 9 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_v30_CHOCOPhlAn_201901_RELAB_profile.tsv' AS ending FROM part WHERE p_partkey % 4 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_v30_CHOCOPhlAn_201901_bowtie2.tsv' AS ending FROM part WHERE p_partkey % 13 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_mpa_v30_CHOCOPhlAn_201901_STATS_profile.tsv' AS ending FROM part WHERE p_partkey % 3 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_HM40_2_genefamilies.tsv' AS ending FROM part WHERE p_partkey % 8 <> 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_profile.tsv' AS ending FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_genefamilies.tsv' AS ending FROM part WHERE p_partkey % 9 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_kos.tsv' AS ending FROM part WHERE p_partkey % 18 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_pfams.tsv' AS ending FROM part WHERE p_partkey % 27 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_ecs.tsv' AS ending FROM part WHERE p_partkey % 36 = 0
UNION ALL SELECT 'SRR' || CAST(p_partkey AS STRING) AS sample, '_kos_rename.tsv' AS ending FROM part WHERE p_partkey % 18 = 0
) AS x""",
    "fx_genefamilies": """
SELECT 'sample' || CAST(l_suppkey AS STRING) AS sample,
  CASE WHEN l_partkey % 10 = 0 THEN 'UNMAPPED' ELSE 'UniRef90_' || CAST(l_partkey AS STRING) || CASE l_returnflag WHEN 'N' THEN '' ELSE '|g__Genus' || l_returnflag || '.s__species' END END AS feature,
  l_quantity AS value FROM lineitem""",
    "fx_groups": """
SELECT 'UniRef90_' || CAST(p_partkey AS STRING) AS feature, 'K' || CAST(p_partkey % 500 AS STRING) AS grp FROM part WHERE p_partkey % 3 <> 0
UNION ALL SELECT 'UniRef90_' || CAST(p_partkey AS STRING) AS feature, 'K' || CAST(500 + p_partkey % 7 AS STRING) AS grp FROM part WHERE p_partkey % 20 = 1""",
    "fx_group_names": """
SELECT 'K' || CAST(k AS STRING) AS grp, 'enzyme ' || CAST(k AS STRING) AS name FROM (SELECT DISTINCT p_partkey % 500 AS k FROM part) AS x WHERE k % 4 <> 0""",
    # First lines of the profiles: most name a database, some have no version, some are blank.
    "fx_first_lines": """
SELECT dir, file, path, CASE WHEN size % 10 = 0 THEN '#' WHEN size % 11 = 0 THEN '#clade_name  x'
  WHEN size % 2 = 0 THEN '#mpa_v30_CHOCOPhlAn_201901' ELSE '# mpa_v31_CHOCOPhlAn_201901 ' END AS first_line
FROM fx_files WHERE file LIKE '%profile.tsv'""",
    # Snapshot files per record table (one table per order) and the policies that override defaults.
    "fx_snapshot_tables": "SELECT 'table' || CAST(o_orderkey AS STRING) AS tbl FROM orders",
    "fx_snapshots": "SELECT 'table' || CAST(o_orderkey AS STRING) AS tbl, o_orderdate AS mod FROM orders WHERE o_orderkey % 9 <> 0",
    "fx_policies": """
SELECT 'table' || CAST(o_orderkey AS STRING) AS tbl,
  CASE o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS force,
  CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 2 = 0 THEN CAST(1 + o_orderkey % 30 AS INT) WHEN o_orderkey % 3 = 2 THEN 0 ELSE NULL END AS months,
  CASE WHEN o_orderkey % 3 = 2 AND o_orderkey % 2 = 1 THEN CAST(o_orderkey % 500 AS INT) WHEN o_orderkey % 3 = 2 THEN 0 ELSE NULL END AS days
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 = 0""",
}


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _parsed(source: str, pattern: str) -> str:
    parts = ", ".join(
        f"NULLIF(regexp_extract(file, '{pattern}', {i}), '') AS {name}"
        for i, name in enumerate(("seqprep", "s_well", "suffix"), 1)
    )
    return f"SELECT *, {parts} FROM {source}"


def _flags(source: str) -> str:
    flags = ", ".join(f"coalesce(bool_or(suffix = '{s}'), FALSE) AS {c}" for c, s in ARTEFACT_FLAGS.items())
    rules = ", ".join(f"{' AND '.join(v)} AS {k}" for k, v in COMPLETION_RULES.items())
    return f"SELECT *, {rules} FROM (SELECT seqprep, min(s_well) AS s_well, {flags} FROM {source} GROUP BY seqprep) AS t"


_PREP_RULE = """
CASE WHEN p.seqprep LIKE 'SEQ%' THEN p.seqprep
  ELSE (SELECT CASE WHEN count(*) = 1 THEN min(s.uid) ELSE min_by(s.uid, s.pos) FILTER (WHERE s.s_well = p.s_well) END
        FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id WHERE b.uid = p.seqprep) END"""

ORACLE_ONLY = {
    "ox_parsed": _parsed("fx_listing", DISK_NAME_PATTERN),
    "ox_files": _parsed("fx_files", DISK_NAME_PATTERN),
    "ox_remote_seq": """
SELECT id, uid, s_well, sequencing_batch, coalesce(kneaddata, FALSE) AS kneaddata, coalesce(metaphlan, FALSE) AS metaphlan, coalesce(humann, FALSE) AS humann
FROM fx_remote WHERE sequencing_batch IS NOT NULL""",
    "ox_flagged": f"""
SELECT p.*, w.n <> 1 AS s_well_ambiguity,
  p.suffix IS NULL OR p.suffix NOT IN ({_names(KNOWN_SUFFIXES)}) AS bad_suffix,
  p.seqprep IS NULL OR p.seqprep NOT IN (SELECT uid FROM ox_remote_seq WHERE uid IS NOT NULL) AS bad_uid
FROM ox_parsed p JOIN (SELECT seqprep, count(DISTINCT coalesce(s_well, '-')) AS n FROM ox_parsed GROUP BY seqprep) w
  ON p.seqprep IS NOT DISTINCT FROM w.seqprep""",
    "ox_good": "SELECT * FROM ox_flagged WHERE NOT (s_well_ambiguity OR bad_suffix OR bad_uid)",
    "ox_problem": "SELECT * FROM ox_flagged WHERE s_well_ambiguity OR bad_suffix OR bad_uid",
    "ox_local": _flags("ox_good"),
    "ox_old_parsed": _parsed("fx_oldnames", DISK_NAME_PATTERN),
    "ox_resolved": f"""
SELECT p.file, p.dir, p.path, p.seqprep AS sample, p.s_well, p.suffix, {_PREP_RULE} AS seqprep
FROM ox_old_parsed p WHERE p.seqprep IS NOT NULL""",
    # A third of the biospecimens are recorded with "-" where their file names have "_". Distinct names
    # are resolved once, by equality first, and the well is looked for in what is left.
    "ox_known_as": """
SELECT id, CASE WHEN CAST(right(uid, 4) AS BIGINT) % 3 = 1 THEN replace(uid, 'FG', 'FG-') ELSE uid END AS uid FROM fx_biospecimens""",
    "ox_named": """
SELECT 'd/' || f AS path, f AS file, s AS sample FROM (
  SELECT replace(file, 'FG', CASE WHEN CAST(right(seqprep, 4) AS BIGINT) % 3 = 1 THEN 'FG_' ELSE 'FG' END) AS f,
    replace(seqprep, 'FG', CASE WHEN CAST(right(seqprep, 4) AS BIGINT) % 3 = 1 THEN 'FG_' ELSE 'FG' END) AS s
  FROM ox_old_parsed WHERE seqprep IS NOT NULL) AS x""",
    "ox_specimen_of": """
SELECT x.file, x.sample, CASE WHEN k.uid IS NOT NULL THEN x.sample ELSE translate(x.sample, '_-', '-_') END AS specimen
FROM (SELECT DISTINCT file, sample FROM ox_named) x LEFT JOIN (SELECT DISTINCT uid FROM ox_known_as) k ON k.uid = x.sample""",
    "ox_specimen_preps": "SELECT b.uid AS specimen, s.uid, s.s_well FROM ox_known_as b JOIN fx_seqpreps s ON s.biospecimen_id = b.id",
    "ox_named_preps": "SELECT g.file, g.sample, s.uid, s.s_well FROM ox_specimen_of g JOIN ox_specimen_preps s ON s.specimen = g.specimen",
    "ox_well_hits": """
SELECT file, sample, count(*) AS n, min(uid) AS uid, min(s_well) AS s_well FROM ox_named_preps WHERE contains(file, '_' || s_well || '_') GROUP BY file, sample""",
    "ox_records": """
SELECT 'Projects' AS tbl, id, uid FROM fx_projects UNION ALL SELECT 'Subjects', id, uid FROM fx_subjects
UNION ALL SELECT 'Biospecimens', id, uid FROM fx_biospecimens UNION ALL SELECT 'SequencingPrep', id, uid FROM fx_seqpreps
UNION ALL SELECT 'Visits', id, uid FROM fx_visits UNION ALL SELECT 'Aliases', id, uid FROM fx_aliases
UNION ALL SELECT 'CollectionBuffer', id, uid FROM fx_buffers UNION ALL SELECT 'MetabolomicsBatches', id, uid FROM fx_metabolomics_batches
UNION ALL SELECT 'SequencingBatches', id, uid FROM fx_sequencing_batches UNION ALL SELECT 'Sites', id, uid FROM fx_sites""",
}

_LINE_KEYS = "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"
_STEP = re.compile(r"\b(?:fx|ox)_\w+")
_SOURCE = re.compile(r"\b(FROM|JOIN)\s+([A-Za-z_]\w*)")


_RECURSIVE = "WITH RECURSIVE"


def oracle_text(sql: str) -> str:
    """``sql`` with every derived step it needs as a common table expression."""
    steps: dict[str, str] = {}

    def need(text: str) -> None:
        for name in sorted(set(_STEP.findall(text))):
            if name not in steps:
                body = DERIVED.get(name) or ORACLE_ONLY[name]
                need(body)
                steps[name] = body

    need(sql)
    if not steps:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in steps.items())
    if sql.strip().startswith(_RECURSIVE):
        return f"{_RECURSIVE} {ctes},\n{sql.strip().removeprefix(_RECURSIVE).strip()}"
    return f"WITH {ctes}\n{sql.strip()}"


class Inputs:
    """Driver tables and derived inputs of one scale folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._build(name)
        return self._known[name]

    def _build(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "fx_line_keys":
            return self._line_keys()
        text = DERIVED[name].replace(_LINE_KEYS, "fx_line_keys").replace("{", "{{").replace("}", "}}")
        sources = {m.group(2) for m in _SOURCE.finditer(text)}
        return self.spark.sql(
            _SOURCE.sub(lambda m: f"{m.group(1)} {{{m.group(2)}}}", text), **{s: self[s] for s in sources}
        )

    def _line_keys(self) -> DataFrame:
        """The distinct keys behind several inputs, as generated rows: conditions of later steps stay
        above them, so all uses in a query have one and the same shuffle, which Spark makes once."""
        keys = self["lineitem"].select("l_orderkey", "l_linenumber").distinct()
        return keys.select(F.inline(F.array(F.struct("l_orderkey", "l_linenumber"))))


_OPENED: WeakKeyDictionary[SparkSession, dict[str, Inputs]] = WeakKeyDictionary()


def inputs_of(spark: SparkSession, sf_dir: str) -> Inputs:
    """The inputs of a folder, opened once per session: table definitions, no data."""
    opened = _OPENED.setdefault(spark, {})
    if sf_dir not in opened:
        opened[sf_dir] = Inputs(spark, sf_dir)
    return opened[sf_dir]
