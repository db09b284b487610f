"""Versions of record tables and the changes between two."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sampleledger.sources import records, versions


def snapshot(spark, rows):
    lines = [(json.dumps({"id": i, "fields": f}),) for i, f in rows.items()]
    return records.parse_records(spark.createDataFrame(lines, "value string"), "Subjects")


def plain(df):
    return {r.id: json.loads(r.f) for r in df.select("id", F.to_json("fields").alias("f")).collect()}


def random_rows(rng, n):
    def value():
        return rng.choice([1, 2.5, True, None, "", "a\"b", [1, "x"], {"b": 1, "a": [None]}, "ä"])

    names = ["uid", "a.b", "a b", "`q`", "x\"y", "n"]
    return {f"rec{i:03d}": {k: value() for k in names if rng.random() < 0.6} for i in range(n) if rng.random() < 0.8}


def test_changes_of_random_snapshots(spark):
    rng = random.Random(11)
    old = random_rows(rng, 120)
    new = random_rows(rng, 120)
    new |= {i: old[i] for i in list(old)[::3]}
    a, b = snapshot(spark, old), snapshot(spark, new)
    changes = versions.snapshot_changes(a, b)
    got = {(r.id, r.change, r.field, r.old_value and json.dumps(json.loads(r.old_value)), r.new_value and json.dumps(json.loads(r.new_value))) for r in changes.collect()}
    want = {(i, "added", None, None, None) for i in new.keys() - old.keys()} | {(i, "removed", None, None, None) for i in old.keys() - new.keys()}
    dumped = lambda f, k: json.dumps(f[k], sort_keys=True) if k in f else None
    for i in old.keys() & new.keys():
        for k in old[i].keys() | new[i].keys():
            if dumped(old[i], k) != dumped(new[i], k):
                want.add((i, "changed", k, dumped(old[i], k), dumped(new[i], k)))
    assert got == want
    assert plain(versions.apply_changes(a, changes, b.join(changes.filter("change = 'added'").select("tbl", "id"), ["tbl", "id"]))) == new


def test_order_of_names_is_no_change(spark):
    old = records.parse_records(spark.createDataFrame([('{"id":"r","fields":{"o":{"a":1,"b":2},"n":1}}',)], "value string"), "Subjects")
    new = records.parse_records(spark.createDataFrame([('{"id":"r","fields":{"n":1,"o":{"b":2,"a":1}}}',)], "value string"), "Subjects")
    assert versions.snapshot_changes(old, new).count() == 0
    assert versions.snapshot_changes(old, new.limit(0)).collect()[0].change == "removed"


def test_versions_are_published_one_after_the_other(spark, tmp_path):
    folder = str(tmp_path / "subjects")
    assert versions.published(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, folder, "Subjects")
    old, new = {"r1": {"uid": "a"}}, {"r1": {"uid": "b"}, "r2": {"uid": "c"}}
    assert versions.publish(snapshot(spark, old), folder) == 1
    first = versions.read_version(spark, folder, "Subjects")
    assert versions.publish(snapshot(spark, new), folder, based_on=1) == 2
    assert plain(first) == old == plain(versions.read_version(spark, folder, "Subjects", 1))
    assert plain(versions.read_version(spark, folder, "Subjects")) == new
    assert {r.uid for r in versions.read_version(spark, folder, "Subjects").collect()} == {"b", "c"}
    with pytest.raises(versions.VersionConflict):
        versions.publish(snapshot(spark, old), folder, based_on=1)
    assert versions.published(spark, folder) == [1, 2]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    folder = str(tmp_path / "subjects")
    versions.publish(snapshot(spark, {"r1": {"uid": "a"}}), folder)
    broken = snapshot(spark, {"r1": {"uid": "b"}}).withColumn("id", F.when(F.col("id") == "r1", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, folder)
    assert versions.published(spark, folder) == [1]
    assert plain(versions.read_version(spark, folder, "Subjects")) == {"r1": {"uid": "a"}}


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "subjects")
    versions.publish(snapshot(spark, {"r1": {"uid": "a"}}), folder)
    monkeypatch.setattr(versions, "published", lambda *_: [])  # a writer that looked before the other was done
    with pytest.raises(versions.VersionConflict):
        versions.publish(snapshot(spark, {"r1": {"uid": "b"}}), folder)
    monkeypatch.undo()
    assert plain(versions.read_version(spark, folder, "Subjects")) == {"r1": {"uid": "a"}}
