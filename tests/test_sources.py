"""Readers and writers on temporary files."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from sampleledger.fixed import RECORD_TABLES
from sampleledger.schemas import LISTING
from sampleledger.sources import listings, records, refresh, tables


@pytest.fixture
def base_dir(tmp_path):
    for table in RECORD_TABLES:
        rows = [{"id": f"rec{table[:4]:x<14}", "fields": {"uid": table.lower(), "keep": 1}}]
        if table == "Subjects":
            rows.append({"id": "recSubjNoUid00000", "fields": {"subject_id": "s9", "Biospecimens": ["a", "b"], "keep": True}})
        (tmp_path / records.snapshot_name(table)).write_text(json.dumps(rows))
    return str(tmp_path)


def test_read_base(spark, base_dir):
    base = records.read_base(spark, base_dir, {"Subjects": "subject_id"}, fmt="array")
    everything = records.all_records(base)
    assert everything.count() == 11
    assert {r.uid for r in base["Subjects"].collect()} == {"subjects", "s9"}
    typed = records.typed(base["Subjects"], "Subjects").filter("uid = 's9'").first()
    assert (typed.Biospecimens, typed.keep, typed.project) == (["a", "b"], 1, None)
    names = {(r.tbl, r.field) for r in records.field_names(everything).collect()}
    assert ("Subjects", "Biospecimens") in names and ("Sites", "Biospecimens") not in names


def test_snapshot_names():
    assert records.snapshot_name("Sequencing Prep") == "airtable_sequencingprep.json"


@pytest.mark.parametrize("fmt", ["lines", "parquet"])
def test_write_snapshot_round_trip(spark, base_dir, tmp_path, fmt):
    subjects = records.read_table(spark, base_dir, "Subjects", "subject_id", "array")
    out = tmp_path / "out" / records.snapshot_name("Subjects")
    records.write_snapshot(subjects, str(out), fmt)
    again = records.read_table(spark, str(out.parent), "Subjects", "subject_id", fmt)
    assert {(r.id, r.uid) for r in again.collect()} == {(r.id, r.uid) for r in subjects.collect()}


def test_imported_snapshots_are_read_by_many_tasks(spark, base_dir, tmp_path):
    for table in RECORD_TABLES:
        records.import_snapshot(spark, base_dir, str(tmp_path / "lines"), table)
    base = records.read_base(spark, str(tmp_path / "lines"), {"Subjects": "subject_id"})
    assert records.all_records(base).count() == 11 and set(base) == set(RECORD_TABLES)


def test_malformed_records_are_told(spark, tmp_path):
    good, bad = '{"id": "rec1", "fields": {"uid": "a"}}', '{"id": 1'
    lines = spark.createDataFrame([(good,), (bad,), ("[]",), ("  ",)], "value string")
    assert sorted(r.value for r in records.rejected_lines(lines).collect()) == ["[]", bad]
    assert [r.uid for r in records.parse_records(lines, "Sites").collect()] == ["a"]
    with pytest.raises(records.RecordError):
        records.parse_records(lines, "Sites", check=True)
    (tmp_path / records.snapshot_name("Sites")).write_text(f"{good}\n{bad}\n")
    with pytest.raises(records.RecordError):
        records.read_table(spark, str(tmp_path), "Sites")
    assert records.read_table(spark, str(tmp_path), "Sites", check=False).count() == 1
    (tmp_path / records.snapshot_name("Visits")).write_text(f"[{good}, {bad}]")
    with pytest.raises(Exception, match="(?i)malformed"):
        records.read_table(spark, str(tmp_path), "Visits", fmt="array").collect()


def test_absent_tables_are_empty(spark):
    lines = spark.createDataFrame([('{"id": "rec1", "fields": {"uid": "a"}}',)], "value string")
    base = records.base_of({"Sites": lines})
    assert set(base) == set(RECORD_TABLES) and records.all_records(base).count() == 1


def test_store_lines_that_cannot_be_read(spark):
    lines = spark.createDataFrame([("2024-01-15 10:00:00 12 k",), ("2024-13-15 10:00:00 12 k",), ("2024-01-15 10:00:00 x k",), ("PRE k/",)], "value string")
    assert listings.parse_store_lines(lines, "b").count() == 1
    assert sorted(r.line for r in listings.rejected_store_lines(lines).collect()) == ["2024-01-15 10:00:00 x k", "2024-13-15 10:00:00 12 k"]


@pytest.mark.parametrize("levels", [0, 2, 9])
def test_list_files_at_any_depth(spark, tmp_path, levels):
    for depth in range(6):
        folder = tmp_path.joinpath(*"abcdef"[:depth])
        folder.mkdir(exist_ok=True)
        (folder / f"f{depth}").write_text("x")
        os.utime(folder / f"f{depth}", ns=(0, 1_700_000_000_123_456_789))
    rows = listings.list_files(spark, str(tmp_path), levels=levels).select("file", F.unix_micros("mod").alias("m")).collect()
    assert sorted(map(tuple, rows)) == [(f"f{d}", 1_700_000_000_123_456) for d in range(6)]


def test_list_files(spark, tmp_path):
    deep = tmp_path / "metaphlan" / "x"
    deep.mkdir(parents=True)
    (deep / "SEQ1_S2_profile.tsv").write_text("abc")
    lower = deep / "a" / "b" / "c" / "d" / "e"
    lower.mkdir(parents=True)
    for path in (tmp_path / "README", tmp_path / ".hidden", lower / "_deep"):
        path.write_text("")
    (tmp_path / "nowhere").symlink_to(tmp_path / "missing")
    (tmp_path / "loop").symlink_to(tmp_path)
    listing = listings.list_files(spark, str(tmp_path))
    assert listing.select(*LISTING.names).schema.simpleString() == LISTING.simpleString()
    rows = {r.file: r for r in listing.collect()}
    assert set(rows) == {"SEQ1_S2_profile.tsv", "README", ".hidden", "_deep", "nowhere"}
    assert listing.count() == 5 and rows["_deep"].dir == str(lower)
    found = rows["SEQ1_S2_profile.tsv"]
    assert (found.size, found.dir, found.seqprep, found.s_well, found.suffix) == (3, str(deep), "SEQ1", "S2", "profile.tsv")
    assert abs(found.mod.timestamp() - os.path.getmtime(deep / "SEQ1_S2_profile.tsv")) < 2


def test_listing_is_spread_over_tasks(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / f"p{i % 4}" / f"q{i}"
        folder.mkdir(parents=True)
        (folder / f"SEQ{i}_S1_profile.tsv").write_text("x")
    listing = listings.list_files(spark, str(tmp_path))
    assert listing.count() == 40
    assert listing.select(F.spark_partition_id().alias("p")).distinct().count() >= 4


def test_data_files_without_contents(spark, tmp_path):
    deep = tmp_path / "x"
    deep.mkdir()
    (deep / "SEQ1_S2.sam").write_text("abc")
    listing = listings.list_data_files(spark, str(tmp_path))
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    row = listing.first()
    assert (row.size, row.path, row.dir, row.seqprep) == (3, str(deep / "SEQ1_S2.sam"), str(deep), "SEQ1")


def test_store_listing(spark, tmp_path):
    path = tmp_path / "ls.txt"
    path.write_text(
        "2024-01-15 10:00:00       12 out/SEQ1_S12_profile.tsv\n"
        "2024-07-15 10:00:00       13 SEQ2_S3.sam\n"
        "                           PRE humann/\n"
        "2024-01-15 10:00:00       12 a key with spaces\n"
    )
    rows = {r.path: r for r in listings.read_store_listing(spark, str(path), "bkt").select(
        "path", "size", "dir", "file", "seqprep", "s_well", "suffix", F.unix_timestamp("mod").alias("t")).collect()}
    assert set(rows) == {"s3://bkt/out/SEQ1_S12_profile.tsv", "s3://bkt/SEQ2_S3.sam"}
    winter, summer = rows["s3://bkt/out/SEQ1_S12_profile.tsv"], rows["s3://bkt/SEQ2_S3.sam"]
    utc = datetime.timezone.utc
    assert winter.t == datetime.datetime(2024, 1, 15, 15, tzinfo=utc).timestamp()
    assert summer.t == datetime.datetime(2024, 7, 15, 14, tzinfo=utc).timestamp()
    assert (winter.size, winter.dir, winter.seqprep, winter.s_well) == (12, "s3://bkt/out", "SEQ1", "S12")


def test_first_lines_of_split_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"s{i}_profile.tsv").write_text(f"#db{i}\n" + "".join(f"row {n}\n" for n in range(3000)))
    (tmp_path / "other.txt").write_text("no\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = listings.first_lines(spark, str(tmp_path), "*profile.tsv").collect()
        scanned = listings.first_lines_of_store(spark, str(tmp_path), "*profile.tsv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.file: r.first_line for r in rows} == {f"s{i}_profile.tsv": f"#db{i}" for i in range(3)}
    assert {(r.path, r.first_line) for r in scanned} == {(r.path, r.first_line) for r in rows}
    assert {r.path for r in rows} == {str(tmp_path / f"s{i}_profile.tsv") for i in range(3)}


def test_id_files(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("ID\n007\n012\n")
    assert [r.ID for r in tables.read_csv(spark, str(tmp_path / "ids.csv")).collect()] == ["007", "012"]
    (tmp_path / "map.csv").write_text("old,new\nA1, N 1 \n,N2\nA3,\n")
    assert [tuple(r) for r in tables.read_mapping(spark, str(tmp_path / "map.csv")).collect()] == [("A1", "N1")]
    (tmp_path / "samples.txt").write_text(" s1\ns2 \n\ns1\n")
    assert sorted(r.sample for r in tables.read_samples(spark, str(tmp_path / "samples.txt")).collect()) == ["s1", "s2"]
    lines = listings.matching_lines(spark.read.text(str(tmp_path / "samples.txt")), r"s\d ")
    assert [r.value for r in lines.collect()] == ["s2 "]
    tables.write_csv(spark.range(2).toDF("n"), str(tmp_path / "out"))
    assert tables.read_csv(spark, str(tmp_path / "out")).count() == 2


def test_refresh_policy_and_staleness(spark):
    names = spark.createDataFrame([(t,) for t in "abcdefg"], "tbl string")
    overrides = spark.createDataFrame(
        [("a", True, None, None), ("b", False, None, None), ("c", None, 0, 7), ("d", False, None, None), ("g", None, 0, 0)],
        "tbl string, force boolean, months int, days int",
    )
    day = datetime.datetime
    mods = spark.createDataFrame(
        [("a", day(2024, 3, 1)), ("b", day(2020, 1, 1)), ("c", day(2024, 2, 20)), ("e", day(2024, 1, 31)), ("f", day(2024, 1, 30)), ("g", day(2024, 3, 1))],
        "tbl string, mod timestamp",
    )
    policy = refresh.refresh_policy(names, overrides)
    stale = {r.tbl: r["update"] for r in refresh.stale_snapshots(policy, mods, day(2024, 2, 29)).collect()}
    # e: Jan 31 + 1 month = Feb 29, not before now; f likewise; d: no snapshot, whatever its policy.
    assert stale == {"a": True, "b": False, "c": True, "d": True, "e": False, "f": False, "g": False}
    later = refresh.stale_snapshots(refresh.uniform_policy(names, days=1), mods, day(2024, 3, 2))
    assert {r.tbl: r["update"] for r in later.collect()} == {"a": False, "b": True, "c": True, "d": True, "e": True, "f": True, "g": False}
