"""Audit and reconciliation on small listings: missing samples, missing wells, doubled keys."""

import pytest

from sampleledger.fixed import ARTEFACT_FLAGS, KNOWN_SUFFIXES
from sampleledger.operators import audit, reconcile, reports


def listing(spark, rows):
    data = [(f"/d/{i}", p, w, s) for i, (p, w, s) in enumerate(rows)]
    return spark.createDataFrame(data, "path string, seqprep string, s_well string, suffix string")


def remote(spark, *uids):
    return spark.createDataFrame([(u,) for u in uids], "uid string")


ROWS = [
    ("A", "S1", "profile.tsv"), ("A", "S1", "bowtie2.tsv"), ("A", "S1", ".sam.bz2"), ("A", "S1", "zzz"),
    ("B", "S1", "profile.tsv"), ("B", "S2", "profile.tsv"),
    ("C", None, "profile.tsv"), ("C", "S1", "profile.tsv"),
    ("D", None, "kneaddata.log"),
    ("E", "S1", "zzz"), ("F", "S1", None), ("G", "S1", "profile.tsv"),
    (None, None, None), (None, None, None),
]


def test_flags(spark):
    flagged = audit.flag_files(listing(spark, ROWS), remote(spark, "A", "B", "C", "D", "E", "F", None))
    got = {(r.path, r.seqprep): (r.s_well_ambiguity, r.bad_suffix, r.bad_uid) for r in flagged.collect()}
    assert len(got) == len(ROWS)
    ambiguous = {"B", "C"}
    for (path, sample), flags in got.items():
        suffix = ROWS[int(path[3:])][2]
        assert flags == (sample in ambiguous, suffix not in KNOWN_SUFFIXES, sample in (None, "G")), (path, sample)
    assert audit.good_files(flagged).count() + audit.problem_files(flagged).count() == len(ROWS)


def test_missing_sample_with_wells_is_ambiguous(spark):
    rows = [(None, "S1", "profile.tsv"), (None, "S2", "profile.tsv"), ("A", "S1", "profile.tsv")]
    got = {r.seqprep: r.s_well_ambiguity for r in audit.well_ambiguity(listing(spark, rows)).collect()}
    assert got == {None: True, "A": False}


def test_local_status_equals_flags_of_good_files(spark):
    files, known = listing(spark, ROWS), remote(spark, "A", "B", "C", "D", "E", "F")
    short = audit.local_status(files, known)
    long = audit.tool_flags(audit.good_files(audit.flag_files(files, known)))
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.select(*short.columns).collect()))
    by_sample = {r.seqprep: r for r in short.collect()}
    assert set(by_sample) == {"A", "D"}
    assert by_sample["A"].metaphlan_complete and not by_sample["A"].humann_complete
    assert by_sample["D"].kneaddata_complete and by_sample["D"].s_well is None


def test_artefact_outside_known_suffixes_proves_nothing(spark):
    rows = [("A", "S1", "profile.tsv"), ("A", "S1", "bowtie2.tsv")]
    files, known = listing(spark, rows), remote(spark, "A")
    short = audit.local_status(files, known, known=("bowtie2.tsv",)).first()
    long = audit.tool_flags(audit.good_files(audit.flag_files(files, known, ("bowtie2.tsv",)))).first()
    assert (short.has_taxprofile, short.has_bowtie2) == (long.has_taxprofile, long.has_bowtie2) == (False, True)


def test_tool_flags_of_all_null_group(spark):
    got = audit.tool_flags(listing(spark, [("A", None, None)])).first()
    assert not any(got[c] for c in ARTEFACT_FLAGS) and got.metaphlan_complete is False


def test_reports(spark):
    files, known = listing(spark, ROWS), remote(spark, "A", "B", "C", "D", "E", "F")
    flagged = audit.flag_files(files, known)
    decided = audit.verdicts(audit.sample_evidence(files), known)
    by_files = reports.problem_report(audit.problem_files(flagged))
    by_samples = reports.problem_report_of(decided)
    order = by_samples.columns
    assert sorted(map(str, by_files.select(*order).collect())) == sorted(map(str, by_samples.collect()))
    assert reports.problem_count(by_samples).first()[0] == 7  # A B C E F G and the missing one


STATUS = "uid string, id string, s_well string, kneaddata boolean, metaphlan boolean, humann boolean"
LOCAL = "seqprep string, s_well string, kneaddata_complete boolean, metaphlan_complete boolean, humann_complete boolean"


def test_reconcile(spark):
    local = spark.createDataFrame(
        [("A", "S1", True, False, False), ("B", "S1", False, False, False), ("C", "S2", True, True, True), ("D", "S1", True, True, True),
         ("E", "S1", True, True, True), ("F", "S1", False, False, False), ("G", "S1", False, False, False), ("G", "S1", False, False, False)], LOCAL)
    remotes = spark.createDataFrame(
        [("A", "ra", "S1", False, True, None), ("B", "rb", None, False, False, False), ("C", "rc", "S1", True, True, True), ("E", "re", "S1", True, True, True),
         ("E", "re2", "S1", True, True, True), ("F", "rf", "S1", False, False, False), ("G", "rg", "S1", True, True, True)], STATUS)
    result = reconcile.reconcile(local, remotes)
    patches = {r.id: (r.s_well, r.kneaddata, r.metaphlan, r.humann) for r in result.patches.collect()}
    assert patches == {"ra": ("S1", True, True, False), "rb": ("S1", False, False, False)}
    assert {r.uid: r.violation for r in result.violations.collect()} == {
        "C": "well mismatch", "D": "absent remotely", "E": "multiple entries", "G": "multiple entries",
    }
    assert {(r.uid, r.tool, r.alert) for r in result.alerts.collect()} == {
        ("A", "kneaddata", "planned update"), ("A", "metaphlan", "missing locally"),
    }
    with pytest.raises(reconcile.ReconcileError):
        result.checked()
    sound = reconcile.reconcile(local.filter("seqprep = 'A'"), remotes)
    assert sound.checked() is sound


def test_resolve_samples(spark):
    files = listing(spark, [("SEQ1", "S9", "x"), ("FG1", "S9", "x"), ("FG2", "S2", "x"), ("FG2", "S7", "x"), ("FG3", "S1", "x"), ("FG4", "S1", "x"), (None, None, None)])
    choices = spark.createDataFrame(
        [("FG1", 0, "Q1", "S1"), ("FG2", 0, "Q2", "S1"), ("FG2", 2, "Q4", "S2"), ("FG2", 1, "Q3", "S2"), ("SEQ1", 0, "no", "S9"), ("FG4", 0, "Q9", None)],
        "biospecimen string, pos int, prep string, prep_well string")
    got = {(r.sample, r.s_well): r.seqprep for r in reconcile.resolve_samples(files, choices).collect()}
    assert got == {("SEQ1", "S9"): "SEQ1", ("FG1", "S9"): "Q1", ("FG2", "S2"): "Q3", ("FG2", "S7"): None, ("FG3", "S1"): None, ("FG4", "S1"): "Q9"}


def test_resolve_by_name_well(spark):
    files = spark.createDataFrame(
        [("p1", "FG1_S1_a", "FG1"), ("p2", "FG_2_S2_a", "FG_2"), ("p3", "FG1_S1_S2_a", "FG1"), ("p4", "FG1_S12_a", "FG1"), ("p5", "x", "no"), ("p6", "y", None)],
        "path string, file string, sample string")
    choices = spark.createDataFrame([("FG1", "Q1", "S1"), ("FG1", "Q2", "S2"), ("FG-2", "Q3", "S2")], "biospecimen string, prep string, prep_well string")
    uids = spark.createDataFrame([("FG1",), ("FG-2",)], "uid string")
    got = {r.path: (r.seqid, r.remote_well) for r in reconcile.resolve_by_name_well(files, choices, uids).collect()}
    none = (None, None)
    assert got == {"p1": ("Q1", "S1"), "p2": ("Q3", "S2"), "p3": none, "p4": none, "p5": none, "p6": none}


def test_old_version_set(spark):
    files = spark.createDataFrame([("a-b",), ("a_b",), ("c-d_e",), ("FE-1",), ("x",)], "biospecimen string")
    old = spark.createDataFrame([("a-b",), ("c_d-e",), ("FE-1",), (None,)], "biospecimen string")
    got = sorted(r.biospecimen for r in reconcile.in_old_version_set(files, old).collect())
    assert got == ["a-b", "a_b", "c-d_e"]


def test_data_checks(spark):
    evidence = audit.sample_evidence(listing(spark, ROWS))
    lines = spark.createDataFrame([("x kneaddata_paired",), ("a_S1_kneaddata_paired_1",), ("other",)], "value string")
    got = {r.check: r.n_failing for r in reports.data_checks(evidence, lines, r"([\w\-]+)_(S\d+)_kneaddata_paired", "kneaddata_paired").collect()}
    assert got == {"unparsed_files": 2, "ambiguous_samples": 2, "unmatched_lines": 1}


def test_repeated_groups_keep_a_missing_group(spark):
    df = spark.createDataFrame([(None, "1"), (None, "2"), ("a", "3"), ("b", "4"), ("b", "5")], "g string, v string")
    got = sorted((str(r.g), r.v, r.n_rows) for r in reports.repeated_groups(df, "g").collect())
    assert got == [("None", "1", 2), ("None", "2", 2), ("b", "4", 2), ("b", "5", 2)]
