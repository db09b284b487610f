"""Records stored for look-ups."""

import pytest
from pyspark.sql import functions as F

from sampleledger.operators import lookups
from sampleledger.sources import stored

N = 20_000


@pytest.fixture(scope="module")
def records(spark):
    n = F.col("id")
    return spark.range(0, N, 1, 8).select(
        F.when(n % 2 == 0, "Subjects").otherwise("Visits").alias("tbl"),
        F.concat(F.lit("rec"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**13)).cast("string"), 14, "0")).alias("id"),
        F.when(n % 100 != 7, F.concat(F.lit("u"), F.lpad(n.cast("string"), 8, "0"))).alias("uid"),
        F.parse_json(F.concat(F.lit('{"n":'), n.cast("string"), F.lit("}"))).alias("fields"),
    )


@pytest.fixture(scope="module")
def folder(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "records")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # eight files of a small table
    try:
        stored.write_stored(records, path)
    finally:
        spark.conf.unset(coalesce)
    return path


def read_rows(df):
    """Rows found, and rows that the scan read."""
    plan = df._jdf.queryExecution().executedPlan()
    found = len(plan.executeCollect())
    return found, plan.collectLeaves().apply(0).metrics().get("numOutputRows").get().value()


def test_an_id_reads_one_range(spark, records, folder):
    wanted = records.filter(F.variant_get("fields", "$.n", "int") == 4242).first()["id"]
    found, read = read_rows(stored.stored_by_id(spark, folder, wanted))
    assert found == 1 and 0 < read <= N / 4
    assert stored.stored_by_id(spark, folder, wanted).first()["uid"] == "u00004242"


def test_an_id_that_is_not_there_reads_nothing(spark, folder):
    found, read = read_rows(stored.stored_by_id(spark, folder, "rec00500000000000x"))
    assert (found, read) == (0, 0)


def test_a_uid_reads_one_range(spark, folder):
    found, read = read_rows(stored.stored_by_uid(spark, folder, "Visits", "u00004243"))
    assert found == 1 and 0 < read <= N / 4
    assert stored.stored_by_uid(spark, folder, "Subjects", "u00004243").count() == 0


def test_stored_records_answer_as_the_others(spark, records, folder):
    again = stored.read_stored(spark, folder)
    plain = lambda df: sorted((r.tbl, r.id, r.uid or "", r.f) for r in df.select("tbl", "id", "uid", F.to_json("fields").alias("f")).collect())
    assert plain(again) == plain(records)
    keys = lookups.key_rows(spark, ["u00000001", "none", "u00000002", "u00000001"])
    assert [(r.pos, r.id) for r in lookups.by_keys(again, keys).orderBy("pos").collect()] == [
        (r.pos, r.id) for r in lookups.by_keys(records, keys).orderBy("pos").collect()]
