"""How the queries run: no Python in the plan, no pair-by-pair joins, skewed keys split."""

import contextlib

import pytest
from pyspark.sql import functions as F

import bench
from sampleledger.catalog import queries
from sampleledger.operators import audit, reconcile
from sampleledger.operators.joins import contained, matched
from sampleledger.plans import ordering, renames

SF_DIR = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    keys = {k.replace("_", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", sorted(queries()))
def test_plan(spark, key):
    """Also where nothing is small enough to broadcast."""
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas", "Window "):
        assert bad not in plan, bad


def _shuffles(spark, key, of="Exchange hashpartitioning("):
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        return queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().count(of)


def test_walks_join_once_per_level(spark):
    assert _shuffles(spark, "j05_project_subjects") <= 4
    assert _shuffles(spark, "j08_all_seqpreps") <= 9


def test_listings_meet_resolved_names_once(spark):
    """A listing is shuffled by its own key where it meets the answers, and nowhere else."""
    assert _shuffles(spark, "j11_resolved_samples", "hashpartitioning(_k0") == 1
    assert _shuffles(spark, "j12_resolved_by_name_well", "hashpartitioning(_k0") == 1
    assert _shuffles(spark, "a06_tool_flags") <= _shuffles(spark, "a07_completion")


def test_headline_queries_exist():
    assert set(bench.HEADLINE) <= set(queries())


def test_columns_are_pruned_and_filters_pushed(spark):
    plan = queries()["a20_distinct_rows"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    subjects = queries()["l12_invalid_projects"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "n_regionkey" not in subjects


def _hot_listing(spark, rows=60000):
    """A third of the files belong to one sample, a third to none."""
    n = F.col("id")
    sample = F.when(n % 3 == 0, "HOT").when(n % 3 == 1, F.concat(F.lit("S"), (n % 997).cast("string")))
    return spark.range(0, rows, 1, 12).select(
        F.concat(F.lit("/data/dir/"), n.cast("string"), F.lit("_file_with_a_long_name")).alias("path"),
        sample.alias("seqprep"),
        F.when(sample.isNotNull(), F.lit("S1")).alias("s_well"),
        F.lit("profile.tsv").alias("suffix"),
        n.cast("string").alias("file"),
        F.lit("/data/dir").alias("dir"),
    )


_SPLITTING = {
    "spark_sql_autoBroadcastJoinThreshold": -1,
    "spark_sql_adaptive_autoBroadcastJoinThreshold": -1,
    "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "40KB",
    "spark_sql_adaptive_skewJoin_skewedPartitionFactor": 2,
    "spark_sql_adaptive_advisoryPartitionSizeInBytes": "40KB",
}


@contextlib.contextmanager
def splitting(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        with settings(spark, **_SPLITTING):
            yield
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.count()  # a plan of its own; the one below is what is looked at
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    return rows, query.executedPlan().toString()


def test_hot_sample_is_split_in_the_audit(spark):
    files = _hot_listing(spark)
    known = spark.range(0, 500).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("uid"))
    with splitting(spark):
        rows, plan = _final_plan(audit.flag_files(files, known))
    assert rows == 60000
    assert "skew=true" in plan


@pytest.mark.parametrize("key", ["a01_well_ambiguity", "a08_good_files", "a08_problem_files"])
def test_files_are_not_sorted_to_meet_their_samples(spark, key):
    """A task makes a hash table of its samples; the files, many to a sample, stream by."""
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    [join] = [line for line in plan.splitlines() if "Join" in line and "_k0" in line]
    assert "ShuffledHashJoin" in join and "BuildRight" in join
    assert not [line for line in plan.splitlines() if "Sort [_k0" in line]


def test_missing_samples_are_scattered(spark):
    """No partition of the join holds the third of the rows that has no sample."""
    files = _hot_listing(spark).filter("seqprep IS NULL OR seqprep <> 'HOT'")
    known = spark.range(0, 500).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("uid"))
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1, spark_sql_adaptive_enabled="false"):
        sizes = [r[0] for r in audit.unknown_uids(files, known).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_hot_keys_are_split_against_grouped_sides(spark):
    files = _hot_listing(spark).withColumn("oldname", F.coalesce("seqprep", "path"))
    grouped = files.groupBy("oldname").agg(F.count(F.lit(1)).alias("n"))
    with splitting(spark):
        rows, plan = _final_plan(matched(files, grouped, "oldname"))
    assert rows == 60000 and "skew=true" in plan


def test_hot_needle_is_split(spark):
    texts = _hot_listing(spark).select("path", F.concat(F.coalesce("seqprep", F.lit("none")), F.lit("_x")).alias("file"))
    needles = spark.range(0, 3000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("needle")).union(
        spark.createDataFrame([("HOT",)], "needle string"))
    with splitting(spark):
        rows, plan = _final_plan(contained(texts.withColumn("pad", F.repeat("path", F.lit(4))), "file", needles, "needle"))
    assert "skew=true" in plan and rows >= 20000


def test_hot_sample_is_split_when_resolved(spark):
    files = _hot_listing(spark)
    choices = spark.range(0, 1500).select(
        F.concat(F.lit("S"), (F.col("id") % 1000).cast("string")).alias("biospecimen"), F.col("id").alias("pos"),
        F.concat(F.lit("SEQ"), F.col("id").cast("string")).alias("prep"), F.lit("S1").alias("prep_well"))
    with splitting(spark):
        rows, plan = _final_plan(reconcile.resolve_samples(files, choices))
    assert rows == 40000 and "skew=true" in plan


def test_hot_target_is_split(spark):
    listing = _hot_listing(spark).select(
        F.lit("d").alias("dir"), F.concat(F.when(F.col("seqprep") == "HOT", F.lit("HOT")).otherwise(F.col("path")), F.lit("ab")).alias("file"), "path")
    with splitting(spark):
        rows, plan = _final_plan(renames.rename_substring(listing, "ab", ""))
    assert rows == 60000 and "skew=true" in plan


@pytest.mark.parametrize("key", ["r07_insert_database", "r06_rename_by_mapping", "r06_unmatched_ids", "r01_rename_unambiguous"])
def test_nothing_that_grows_with_the_files_is_broadcast(spark, key):
    """Nor where the statistics call it small: they know no rows that an explode makes."""
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="1GB"):
        plan = queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in joins if any(c in line for c in ("_piece", "_l0", "_k0"))]


def test_renames_in_order_broadcast_nothing_that_grows(spark, monkeypatch):
    plans, keep = [], ordering.kept
    monkeypatch.setattr(ordering, "kept", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    files = spark.createDataFrame([("d", "A1_x", "d/A1_x"), ("d", "A2_x", "d/A2_x")], "dir string, file string, path string")
    rules = spark.createDataFrame([(1, "A1_", "A2_"), (2, "A2_", "B_")], "seq bigint, old_id string, new_id string")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="1GB"):
        ordering.rename_in_order(files, rules)
    assert plans and not any("BroadcastHashJoin" in plan for plan in plans)


def test_unmatched_ids_meet_the_names_once(spark):
    """One join, and names are cut by compiled code, not by functions on arrays."""
    ids = spark.createDataFrame([("A1",), ("A2",), ("A1",), ("",), (None,)], "old_id string")
    files = spark.createDataFrame([("xA1_A1",), ("A1",), ("A",), (None,)], "file string")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        df = renames.unmatched_ids(files, ids)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    assert sorted(str(r.old_id) for r in df.collect()) == ["", "A2", "None"]


def test_moves_resolve_their_names_once(spark):
    """Files under two spellings, and files listed twice, are rows of one resolved listing."""
    assert _shuffles(spark, "j12_repeated_paths") == _shuffles(spark, "j12_resolved_by_name_well")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        plan = queries()["r02_move_old_names"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 6


def test_pair_files_are_not_made_distinct_before_they_are_grouped(spark):
    files = spark.createDataFrame([("B1", "S1", "f"), ("B1", "S1", "f"), ("B2", "S1", "g")], "biospecimen string, s_well string, file string")
    listing = spark.createDataFrame([("B1", "S1", "Q2"), ("B1", "S1", "Q1")], "biospecimen string, s_well string, sample string")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        df = reconcile.attach_samples(files, listing)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4
    assert [tuple(r) for r in df.collect()] == [("f", "B1", "S1", "Q1")]


def test_words_of_a_file_listed_twice_hit_one_well(spark):
    files = spark.createDataFrame([("p", "B1_S1_x", "B1"), ("p", "B1_S1_x", "B1"), ("q", "B1_S1_S2_x", "B1"), ("r", "B1_S3_x", "B1")], "path string, file string, sample string")
    preps = spark.createDataFrame([("B1", 1, "Q1", "S1"), ("B1", 2, "Q2", "S2"), ("B1", 3, "Q3", "S3"), ("B1", 4, "Q4", "S3")], "biospecimen string, pos int, prep string, prep_well string")
    uids = spark.createDataFrame([("B1",)], "uid string")
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        df = reconcile.resolve_by_name_well(files, preps, uids)
        plan = df._jdf.queryExecution().executedPlan().toString()
    # one less than with the files made distinct first
    assert plan.count("Exchange hashpartitioning") <= 9
    assert sorted((r.path, r.seqid) for r in df.collect()) == [("p", "Q1"), ("p", "Q1"), ("q", None), ("r", None)]


def _reused(spark, df):
    """The plan, and how often it uses a shuffle that is there already."""
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1, spark_sql_adaptive_enabled="false"):
        plan = df(spark)._jdf.queryExecution().executedPlan().toString()
    return plan, plan.count("ReusedExchange")


@pytest.mark.parametrize("key", ["r04_replace_or_move", "r01_rename_unambiguous", "j11_resolved_samples", "r09_rename_pairs", "a08_good_files"])
def test_conditions_do_not_parse_names_again(spark, key):
    """Nor do they go below the distinct keys, which are read and shuffled once for all uses."""
    plan, _ = _reused(spark, lambda s: queries()[key](s, SF_DIR))
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_" in line]
    if key != "a08_good_files":
        assert sum("FileScan" in line and "lineitem" in line for line in plan.splitlines()) == 1


def test_plans_share_the_shuffles_below_their_targets(spark):
    parsed = spark.createDataFrame([("d/A_S1", "A", "S1"), ("d/B_S1", "B", "S1"), ("d/Q9_S1", "Q9", "S1")], "path string, seqprep string, s_well string")
    pairs = spark.createDataFrame([("A", "S1", "Q1"), ("B", "S1", "Q1")], "sample string, s_well string, seqprep string")
    _, reused = _reused(spark, lambda s: renames.rename_pairs(parsed, pairs))
    assert reused == 2
    elsewhere = spark.createDataFrame([("d/Q1_S1",)], "path string")
    assert {r.path: r.action for r in renames.rename_pairs(parsed, pairs).collect()} == {"d/A_S1": "rename", "d/B_S1": "clash"}
    assert {r.action for r in renames.rename_pairs(parsed, pairs, elsewhere).collect()} == {"exists"}


def test_wells_are_counted_on_the_shuffles_of_the_plan(spark):
    renamed = spark.createDataFrame([("A", "S1", "p", "n")], "oldname string, s_well string, path string, newpath string").repartition(3, "path")
    listing = spark.createDataFrame([("p",)], "path string")
    assert _reused(spark, lambda s: renames.rename_unambiguous(renamed, listing))[1] >= 2


def test_choices_are_grouped_once(spark):
    files = spark.createDataFrame([("p", "B1", "S1")], "path string, seqprep string, s_well string")
    preps = spark.createDataFrame([("B1", 1, "Q1", "S1")], "biospecimen string, pos int, prep string, prep_well string")
    _, reused = _reused(spark, lambda s: reconcile.resolve_samples(files, preps))
    assert reused == 1
