"""File names, paths, visit ids and header lines."""

import pytest
from pyspark.sql import functions as F

from sampleledger.functions import names
from sampleledger.operators import lookups

DISK = {
    "SEQ01071_S26_kneaddata.log": ("SEQ01071", "S26", "kneaddata.log"),
    "SEQ9_S42.sam.bz2": ("SEQ9", "S42", ".sam.bz2"),
    "X_S42": ("X", "S4", "2"),
    "X_S4": (None, None, None),
    "A_S1_B_S2_p.tsv": ("A_S1_B", "S2", "p.tsv"),
    "X_S123_profile.tsv": ("X", "S123", "profile.tsv"),
    "my file-SEQ1_S3_x": (None, None, None),
    "README": (None, None, None),
    "": (None, None, None),
    None: (None, None, None),
}
STORE = {
    "X_S123_profile.tsv": ("X", "S12", "3_profile.tsv"),
    "my file-SEQ1_S3_x": ("file-SEQ1", "S3", "x"),
    "A_S1_B_S2_p.tsv": ("A_S1_B", "S2", "p.tsv"),
    "README": (None, None, None),
}


@pytest.mark.parametrize("mode, cases", [("disk", DISK), ("store", STORE)])
def test_name_parts(spark, mode, cases):
    df = spark.createDataFrame([(f,) for f in cases], "file string")
    rows = names.with_name_parts(df, mode=mode).collect()
    assert {r["file"]: (r["seqprep"], r["s_well"], r["suffix"]) for r in rows} == cases


def test_paths(spark):
    df = spark.createDataFrame([("/a/b/c.tsv",), ("c.tsv",), ("/c.tsv",), ("s3://b/k/x",)], "p string")
    rows = df.select("p", names.dir_of(F.col("p")).alias("d"), names.file_of(F.col("p")).alias("f")).collect()
    assert {r.p: (r.d, r.f) for r in rows} == {
        "/a/b/c.tsv": ("/a/b", "c.tsv"), "c.tsv": ("", "c.tsv"), "/c.tsv": ("/", "c.tsv"), "s3://b/k/x": ("s3://b/k", "x"),
    }


def test_visit_ids(spark):
    cases = {
        "SD0012A": (12, 1, "C"), "SDM0012C": (12, 3, "M"), "SD1Z": (1, 26, "C"), "sd1a": None, "SD1": None,
        "SDM12AB": None, "SD99999999999999999999A": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string").withColumn("id", names.visit_id(F.col("v")))
    got = {r.v: r.id and (r.id.subject, r.id.timepoint, r.id.metadata.mother_child) for r in df.collect()}
    assert got == cases


def test_header_lines(spark):
    lines = {"#mpa_v30_CHOCOPhlAn_201901": ("30", "mpa_v30_CHOCOPhlAn_201901"), "# a b\t": (None, "ab"), "# ": (None, None)}
    df = spark.createDataFrame([(k,) for k in lines], "v string")
    rows = df.select("v", names.profile_version(F.col("v")).alias("n"), names.database_name(F.col("v")).alias("d")).collect()
    assert {r.v: (r.n, r.d) for r in rows} == lines


def test_record_ids(spark):
    df = spark.createDataFrame([("rec" + "a1" * 7,), ("rec" + "a" * 13,), ("Projects",), (None,)], "v string")
    got = [r[0] for r in df.select(names.is_record_id(F.col("v"))).collect()]
    assert got == [True, False, False, False]


def test_cleaned_pairs_and_prefixes(spark):
    lines = spark.createDataFrame([("2023 a/FG1_S2_kneaddata_paired_1.fastq.gz",), ("nothing",)], "value string")
    assert {r.file for r in names.cleaned_pairs(lines).collect()} == {
        "FG1_S2_kneaddata_paired_1.fastq.gz", "FG1_S2_kneaddata_paired_2.fastq.gz",
    }
    files = spark.createDataFrame([("b_S1_S2",), ("a_S1",), ("b_S9",), ("none",)], "file string")
    assert [r.prefix for r in names.distinct_prefixes(files, "_S").collect()] == ["a", "b"]


def test_rejected_visits(spark):
    texts = ["SD0012A", "SDM7Z", "sd1A", "SD1", "SD1a", "xSD1A", "SD" + "9" * 19 + "A", "", None, "SD1AB", "SD9223372036854775807C"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, visit string")
    rejects = {r.visit: r.reason for r in lookups.rejected_visits(df).collect()}
    assert rejects == {"sd1A": "pattern", "SD1": "pattern", "SD1a": "pattern", "xSD1A": "pattern", "SD" + "9" * 19 + "A": "subject", "": "pattern", None: "missing", "SD1AB": "pattern"}
    kept = {r.visit: (r.visit_id.subject, r.visit_id.timepoint) for r in lookups.with_visits(df).collect()}
    assert kept == {"SD0012A": (12, 1), "SDM7Z": (7, 26), "SD9223372036854775807C": (9223372036854775807, 3)}
    with pytest.raises(lookups.InvalidVisit) as error:
        lookups.with_visits(df, check=True)
    assert error.value.rejects.count() == len(rejects)
    assert lookups.with_visits(df.filter("n < 2"), check=True).count() == 2
