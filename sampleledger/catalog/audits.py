"""Audit and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.catalog.inputs import Inputs
from sampleledger.catalog.registry import query
from sampleledger.fixed import ARTEFACT_FLAGS, COMPLETION_RULES, KNOWN_SUFFIXES, TOOLS
from sampleledger.functions.names import with_name_parts
from sampleledger.operators import audit, reports

FILE_COLUMNS = ("path", "size", "seqprep", "s_well", "suffix")
_FILES = ", ".join(FILE_COLUMNS)
_FLAGS = ", ".join(("seqprep", "s_well", *ARTEFACT_FLAGS, *COMPLETION_RULES))
_SUFFIXES = ", ".join(f"'{s}'" for s in KNOWN_SUFFIXES)


def parsed_listing(inputs: Inputs) -> DataFrame:
    return with_name_parts(inputs["fx_listing"])


def remote(inputs: Inputs) -> DataFrame:
    return audit.remote_status(inputs["fx_remote"])


def local(inputs: Inputs) -> DataFrame:
    return audit.local_status(parsed_listing(inputs), remote(inputs))


def flagged(inputs: Inputs) -> DataFrame:
    return audit.flag_files(parsed_listing(inputs), remote(inputs))


@query("a01_well_ambiguity", """
SELECT path, size, seqprep, s_well, suffix, s_well_ambiguity FROM ox_flagged""")
def _(inputs):
    return audit.well_ambiguity(parsed_listing(inputs)).select(*FILE_COLUMNS, "s_well_ambiguity")


@query("a02_bad_suffix", "SELECT path, size, suffix, bad_suffix FROM ox_flagged")
def _(inputs):
    return parsed_listing(inputs).select("path", "size", "suffix", audit.bad_suffix(F.col("suffix")).alias("bad_suffix"))


@query("a03_bad_uid", "SELECT path, size, seqprep, bad_uid FROM ox_flagged")
def _(inputs):
    return audit.unknown_uids(parsed_listing(inputs), remote(inputs)).select("path", "size", "seqprep", "bad_uid")


@query("a04_split_counts", """
SELECT count(*) FILTER (WHERE s_well_ambiguity OR bad_suffix OR bad_uid) AS n_problem_files,
  count(*) FILTER (WHERE NOT (s_well_ambiguity OR bad_suffix OR bad_uid)) AS n_good_files FROM ox_flagged""")
def _(inputs):
    return flagged(inputs).agg(
        F.count_if(audit.is_problem()).alias("n_problem_files"), F.count_if(~audit.is_problem()).alias("n_good_files")
    )


@query("a05_remote_status", "SELECT uid, s_well, sequencing_batch, kneaddata, metaphlan, humann FROM ox_remote_seq")
def _(inputs):
    return remote(inputs).select("uid", "s_well", "sequencing_batch", *TOOLS)


@query("a06_tool_flags", f"SELECT seqprep, s_well, {', '.join(ARTEFACT_FLAGS)} FROM ox_local")
def _(inputs):
    return local(inputs).select("seqprep", "s_well", *ARTEFACT_FLAGS)


@query("a07_completion", f"SELECT {_FLAGS} FROM ox_local")
def _(inputs):
    return local(inputs).select("seqprep", "s_well", *ARTEFACT_FLAGS, *COMPLETION_RULES)


def _audit(inputs: Inputs) -> audit.Audit:
    return audit.audit_listing(parsed_listing(inputs), inputs["fx_remote"])


@query("a08_remote_seq", "SELECT id, uid, s_well, sequencing_batch, kneaddata, metaphlan, humann FROM ox_remote_seq")
def _(inputs):
    return _audit(inputs).remote_seq.select("id", "uid", "s_well", "sequencing_batch", *TOOLS)


@query("a08_local_seq", f"SELECT {_FLAGS} FROM ox_local")
def _(inputs):
    return _audit(inputs).local_seq


@query("a08_good_files", f"SELECT {_FILES} FROM ox_good")
def _(inputs):
    return _audit(inputs).good_files.select(*FILE_COLUMNS)


@query("a08_problem_files", f"SELECT {_FILES}, s_well_ambiguity, bad_suffix, bad_uid FROM ox_problem")
def _(inputs):
    return _audit(inputs).problem_files.select(*FILE_COLUMNS, *audit.PROBLEM_FLAGS)


_PROBLEM_REPORT = """
SELECT seqprep, bool_or(s_well_ambiguity) AS check_s_well, bool_or(bad_suffix) AS check_suffices, bool_or(bad_uid) AS check_uid
FROM ox_problem GROUP BY seqprep"""


@query("a09_problem_report", _PROBLEM_REPORT)
def _(inputs):
    return reports.problem_report(audit.problem_files(flagged(inputs)))


@query("a09_problem_count", "SELECT count(*) AS n_problem_ids FROM (SELECT DISTINCT seqprep FROM ox_problem) AS d")
def _(inputs):
    return reports.problem_count(reports.audit_report(_audit(inputs))["problems"])


_COUNTS = "UNION ALL".join(
    f" SELECT '{t}' AS thing, (SELECT count(*) FROM ox_local WHERE {t}_complete) AS n_local, (SELECT count(*) FROM ox_remote_seq WHERE {t}) AS n_remote "
    for t in TOOLS
)


@query("a10_compare_counts", f"""
SELECT *, n_local - n_remote AS diff FROM (
SELECT 'sequences' AS thing, (SELECT count(*) FROM ox_local) AS n_local, (SELECT count(*) FROM ox_remote_seq) AS n_remote
UNION ALL {_COUNTS}) AS c""")
def _(inputs):
    return reports.compare_counts(local(inputs), remote(inputs))


def _difference(label: str, local_first: bool) -> str:
    cells = []
    for t in TOOLS:
        loc = f"SELECT seqprep FROM ox_local WHERE {t}_complete"
        rem = f"SELECT uid FROM ox_remote_seq WHERE {t}"
        a, b = (loc, rem) if local_first else (rem, loc)
        cells.append(f"(SELECT count(*) FROM ({a} EXCEPT {b}) AS d) AS {t}")
    return f"SELECT '{label}' AS thing, {', '.join(cells)}"


@query("a11_discrepancies", _difference("Local, not remote", True) + " UNION ALL " + _difference("Remote, not local", False))
def _(inputs):
    return reports.discrepancies(local(inputs), remote(inputs))


@query("a12_report_counts", f"""
SELECT *, n_local - n_remote AS diff FROM (
SELECT 'sequences' AS thing, (SELECT count(*) FROM ox_local) AS n_local, (SELECT count(*) FROM ox_remote_seq) AS n_remote
UNION ALL {_COUNTS}) AS c""")
def _(inputs):
    return reports.audit_report(_audit(inputs))["counts"]


@query("a12_report_discrepancies", _difference("Local, not remote", True) + " UNION ALL " + _difference("Remote, not local", False))
def _(inputs):
    return reports.audit_report(_audit(inputs))["discrepancies"]


@query("a12_report_problems", _PROBLEM_REPORT)
def _(inputs):
    return reports.audit_report(_audit(inputs))["problems"]


@query("a16_sample_kinds", """
SELECT count(DISTINCT seqprep) + max(CASE WHEN seqprep IS NULL THEN 1 ELSE 0 END) AS n_groups,
  count(DISTINCT CASE WHEN seqprep LIKE 'SEQ%' THEN seqprep END) AS n_sequencing,
  count(DISTINCT CASE WHEN seqprep NOT LIKE 'SEQ%' THEN seqprep END) AS n_other FROM ox_old_parsed""")
def _(inputs):
    return reports.sample_kinds(with_name_parts(inputs["fx_oldnames"]))


@query("a17_completion_totals", """
SELECT count(*) FILTER (WHERE kneaddata_complete) AS n_kneaddata, count(*) FILTER (WHERE metaphlan_complete) AS n_metaphlan,
  count(*) FILTER (WHERE has_taxprofile) AS n_taxprofile, count(*) FILTER (WHERE humann_basic_complete) AS n_humann_basic,
  count(*) FILTER (WHERE humann_complete) AS n_humann_grprn FROM ox_local""")
def _(inputs):
    return reports.completion_totals(local(inputs))


@query("a18_data_checks", r"""
SELECT 'unparsed_files' AS "check", count(*) AS n_failing FROM ox_parsed WHERE seqprep IS NULL
UNION ALL SELECT 'ambiguous_samples', count(*) FROM (SELECT seqprep FROM ox_parsed GROUP BY seqprep HAVING count(DISTINCT coalesce(s_well, '-')) <> 1) AS g
UNION ALL SELECT 'unmatched_lines', count(*) FROM fx_store_lines WHERE value LIKE '%kneaddata_paired%' AND NOT regexp_matches(value, '([\w\-]+)_(S\d+)_kneaddata_paired')""")
def _(inputs):
    from sampleledger.fixed import CLEANED_PAIR_PATTERN

    evidence = audit.sample_evidence(parsed_listing(inputs))
    return reports.data_checks(evidence, inputs["fx_store_lines"], CLEANED_PAIR_PATTERN, "kneaddata_paired")


@query("a19_repeated_groups", """
SELECT oldname, seqname, n_seqs FROM (
  SELECT b.uid AS oldname, s.uid AS seqname, count(*) OVER (PARTITION BY b.uid) AS n_seqs
  FROM fx_biospecimens b JOIN fx_seqpreps s ON s.biospecimen_id = b.id) AS m WHERE n_seqs > 1""")
def _(inputs):
    pairs = (
        inputs["fx_biospecimens"].select(F.col("id").alias("biospecimen_id"), F.col("uid").alias("oldname"))
        .join(inputs["fx_seqpreps"].select("biospecimen_id", F.col("uid").alias("seqname")), "biospecimen_id")
        .select("oldname", "seqname")
    )
    return reports.repeated_groups(pairs, "oldname", "n_seqs")


@query("a20_distinct_rows", "SELECT DISTINCT seqprep, s_well FROM ox_parsed")
def _(inputs):
    return reports.distinct_rows(parsed_listing(inputs), "seqprep", "s_well")


@query("a21_first_rows", "SELECT path, size FROM fx_listing ORDER BY path, size LIMIT 5")
def _(inputs):
    return reports.first_rows(inputs["fx_listing"].select("path", "size"), 5, "path", "size")


@query("a22_old_name_files", "SELECT file, seqprep, s_well FROM ox_old_parsed WHERE seqprep NOT LIKE 'SEQ%'")
def _(inputs):
    parsed = with_name_parts(inputs["fx_oldnames"])
    return reports.old_name_files(parsed, "seqprep").select("file", "seqprep", "s_well")


@query("a23_concatenated", """
SELECT file, dir, path, mod, size FROM fx_files UNION ALL SELECT file, dir, path, NULL, NULL FROM fx_oldnames""")
def _(inputs):
    return reports.concatenate(inputs["fx_files"], inputs["fx_oldnames"])


@query("a24_suffix_problems", f"""
SELECT path, seqprep, suffix FROM ox_files WHERE suffix IS NULL OR suffix NOT IN ({_SUFFIXES})""")
def _(inputs):
    return audit.suffix_problems(with_name_parts(inputs["fx_files"])).select("path", "seqprep", "suffix")
