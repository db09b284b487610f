"""Rename plans, manifests and abundance tables; substring joins against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sampleledger.operators.joins import contained
from sampleledger.plans import abundance, manifests, renames, sync


def files(spark, *names):
    return spark.createDataFrame([("d", n, f"d/{n}") for n in names], "dir string, file string, path string")


def samples(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "sample string")


@pytest.mark.parametrize("anchored", [False, True])
def test_contained_equals_brute_force(spark, anchored):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abé_1") for _ in range(rng.randint(0, 14))) for _ in range(150)]
    needles = {"".join(rng.choice("abé_1") for _ in range(rng.randint(1, 6))) for _ in range(60)}
    for chosen in (needles, {n for n in needles if len(n) > 3}, {"a"}, set()):
        t = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
        d = spark.createDataFrame([(x,) for x in chosen] + [("",)], "needle string")
        got = sorted((r.n, r.needle) for r in contained(t, "text", d, "needle", anchored).collect())
        want = sorted((i, x) for i, s in enumerate(texts) for x in chosen if (s.startswith(x) if anchored else x in s))
        assert got == want


def test_rename_by_map(spark):
    listing = files(spark, "FG00004_S26_a", "FG00004_S46_a", "FG00006_S1_FG00006", "FE00001_S1_a", "SEQ1_S1_a", "xFG00006_S1_a")
    names = renames.one_name_each(spark.createDataFrame(
        [("FG00004", "SEQ01071"), ("FG00004", "SEQ02505"), ("FG00006", "SEQ00729")], "oldname string, seqname string"))
    renamed = renames.renamed_by_map(listing, names)
    plan = {r.path: (r.newpath, r.action) for r in renames.rename_unambiguous(renamed, listing).collect()}
    assert plan == {
        "d/FG00004_S26_a": ("d/SEQ01071_S26_a", "ambiguous"), "d/FG00004_S46_a": ("d/SEQ01071_S46_a", "ambiguous"),
        "d/FG00006_S1_FG00006": ("d/SEQ00729_S1_SEQ00729", "rename"),
    }
    assert [r.oldname for r in renames.unnamed_files(listing, names).collect()] == ["FE00001"]


def test_moves(spark):
    schema = "dir string, file string, path string, sample string, seqprep string"
    resolved = spark.createDataFrame([
        ("s3://b/output/x/output/k", "FG1_S1_a", "1", "FG1", "SEQ1"), ("s3://b/output/k", "FG2_S1_a", "2", "FG2", "SEQ2"),
        ("s3://b/output/k", "FG3_S1_a", "3", "FG3", None), ("s3://b/output/k", "SEQ9_S1_a", "4", "SEQ9", "SEQ9")], schema)
    existing = spark.createDataFrame([("SEQ2_S1_a",), ("other",)], "file string")
    plan = {r.path: (r.newpath, r.action) for r in renames.move_across(resolved, existing, "s3://p/").collect()}
    assert plan == {"1": ("s3://p/k/SEQ1_S1_a", "move"), "2": ("s3://p/k/SEQ2_S1_a", "exists"), "3": (None, "unresolved")}
    local = resolved.withColumnRenamed("seqprep", "seqid")
    assert {r.path: r.action for r in renames.replace_or_move(local, existing).collect()} == {"1": "move", "2": "remove", "4": "move"}


def test_of_several_files_with_one_target_one_is_moved(spark):
    schema = "dir string, file string, path string, sample string, seqprep string"
    resolved = spark.createDataFrame([
        ("d", "FG1_S1_p.tsv", "d/FG1_S1_p.tsv", "FG1", "SEQ1"), ("d", "FG-1_S1_p.tsv", "d/FG-1_S1_p.tsv", "FG-1", "SEQ1"),
        ("e", "FG1_S1_p.tsv", "e/FG1_S1_p.tsv", "FG1", "SEQ1")], schema)
    none = spark.createDataFrame([], "file string, path string")
    plan = {r.path: r.action for r in renames.move_old_names(resolved, none).collect()}
    assert plan == {"d/FG-1_S1_p.tsv": "move", "d/FG1_S1_p.tsv": "clash", "e/FG1_S1_p.tsv": "move"}
    assert {r.action for r in renames.replace_or_move(resolved, none, "seqprep").collect()} == {"move", "clash"}
    listing = files(spark, "A1_x", "B1_x", "D1_x", "N_x")
    mapping = spark.createDataFrame([("A1", "C"), ("B1", "C"), ("D1", "N")], "old_id string, new_id string")
    plan = {r.path: (r.newpath, r.action) for r in renames.rename_by_mapping(listing.unionAll(listing), mapping).collect()}
    assert plan == {"d/A1_x": ("d/C_x", "rename"), "d/B1_x": ("d/C_x", "clash"), "d/D1_x": ("d/N_x", "conflict")}
    names = spark.createDataFrame([("FG00001", "SEQ1"), ("FG00002", "SEQ1"), ("FG00003", "SEQ3")], "oldname string, newname string")
    listing = files(spark, "FG00001_S1_a", "FG00002_S1_a", "FG00003_S1_a", "SEQ3_S1_a")
    renamed = renames.renamed_by_map(listing, names)
    assert {r.path: r.action for r in renames.rename_unambiguous(renamed, listing).collect()} == {
        "d/FG00001_S1_a": "rename", "d/FG00002_S1_a": "clash", "d/FG00003_S1_a": "exists"}
    parsed = spark.createDataFrame([("A", "S1", "d/A_S1"), ("B", "S1", "d/B_S1"), ("C", "S1", "d/C_S1"), ("E", "S1", "d/E_S1")], "seqprep string, s_well string, path string")
    pairs = spark.createDataFrame([("A", "S1", "X"), ("B", "S1", "X"), ("C", "S1", "E")], "sample string, s_well string, seqprep string")
    assert {r.path: r.action for r in renames.rename_pairs(parsed, pairs).collect()} == {"d/A_S1": "rename", "d/B_S1": "clash", "d/C_S1": "exists"}


def test_the_root_is_cut_at_the_start_alone(spark):
    paths = ["/data/raw/data/f", "/data/raw/f", "/data2/f", "/data"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(sync.relative_path(F.col("p"), "/data/")).collect()]
    assert got == ["raw/data/f", "raw/f", "data2/f", "data"]


def test_rename_substring(spark):
    listing = files(spark, "abx", "xab", "y_ab", "y_", "zab", "none")
    plan = {r.path: r.action for r in renames.rename_substring(listing, "ab", "").collect()}
    assert plan == {"d/abx": "rename", "d/xab": "clash", "d/y_ab": "exists", "d/zab": "rename"}


def test_mapping_takes_the_longest_id(spark):
    mapping = spark.createDataFrame([("A1", "N1"), ("A12", "N12"), ("ZZ", "N9")], "old_id string, new_id string")
    listing = files(spark, "A12_x", "A1_A1", "N1_c", "A1_c", "none")
    plan = {r.path: (r.newpath, r.n_mappings, r.action) for r in renames.rename_by_mapping(listing, mapping).collect()}
    assert plan == {"d/A12_x": ("d/N12_x", 2, "rename"), "d/A1_A1": ("d/N1_N1", 1, "rename"), "d/A1_c": ("d/N1_c", 1, "conflict")}
    assert [r.old_id for r in renames.unmatched_ids(listing, mapping).collect()] == ["ZZ"]


def test_insert_database(spark):
    lines = spark.createDataFrame([("d", "sA_profile.tsv", "#db1"), ("d", "sAB_profile.tsv", "# db 2"), ("d", "sC_profile.tsv", "# "), ("d", "log", "#no")],
                                  "dir string, file string, first_line string")
    listing = files(spark, "sA_profile.tsv", "sAB_profile.tsv", "sAX.sam", "sA_db1.sam", "sC_profile.tsv")
    plan = {r.path: r.newpath for r in renames.insert_database(listing, lines).collect()}
    assert plan == {"d/sA_profile.tsv": "d/sA_db1_profile.tsv", "d/sAB_profile.tsv": "d/sAB_db2_profile.tsv", "d/sAX.sam": "d/sA_db1X.sam"}


def test_copy_page_and_pairs(spark):
    numbered = spark.createDataFrame([(f"f{i:03d}", f"n{i:03d}") for i in range(1, 201)], "file string, newfile string")
    page = sorted(tuple(r) for r in renames.copy_page(numbered, "in/", "out/", 51, 150).collect())
    assert (len(page), page[0], page[-1]) == (100, ("in/f051", "out/n051"), ("in/f150", "out/n150"))
    listing = spark.createDataFrame([("FG02294", "S1", "a/FG02294_S1_x"), ("FG02294", "S10", "a/FG02294_S10_x")], "seqprep string, s_well string, path string")
    pairs = spark.createDataFrame([("FG02294", "S1", "SEQ01783")], "sample string, s_well string, seqprep string")
    assert [tuple(r) for r in renames.rename_pairs(listing, pairs).collect()] == [("a/FG02294_S1_x", "a/SEQ01783_S1_x", "SEQ01783", "rename")]


def test_sync(spark):
    t, u = "2024-01-01 00:00:00", "2024-01-01 00:00:01"

    def listing(*rows):
        return spark.createDataFrame(rows, "rel string, size bigint, m string").select("rel", "size", F.to_timestamp("m").alias("mod"))

    source = listing(("same", 1, t), ("new", 1, t), ("size", 1, t), ("time", 1, t))
    there = listing(("same", 1, t), ("size", 2, t), ("time", 1, u), ("extra", 1, t))
    assert {r.rel: r.reason for r in sync.sync_plan(source, there).collect()} == {"new": "absent", "size": "size", "time": "time"}
    assert {r.rel for r in sync.sync_plan(source, there, exact_time=False).collect()} == {"new", "size"}


def test_raw_inputs(spark):
    listing = files(spark, "S1_1.fastq.gz", "S1_2.FQ", "S1.fastq", "S10_1.fastq", "S2_1.fq", "S2_1.fastq.gz", "S2_2.fq", "S3.txt", "S4_1.fastq")
    got = {r.sample: r for r in manifests.pairing(manifests.raw_inputs(listing, samples(spark, "S1", "S10", "S2", "S3", "S4_1"))).collect()}
    assert {s: r.status for s, r in got.items()} == {"S1": "ok", "S10": "single_mate", "S2": "duplicate", "S3": "none", "S4_1": "ok"}
    assert (got["S1"].paired_1, got["S1"].paired_2, got["S1"].unpaired) == ("d/S1_1.fastq.gz", "d/S1_2.FQ", "d/S1.fastq")
    assert (got["S1"].has_pair, got["S1"].has_orphan, got["S4_1"].has_pair, got["S4_1"].has_orphan) == (True, True, False, True)


def test_cleaned_outputs_and_concat(spark):
    listing = files(
        spark, "S1_kneaddata_paired_1.fastq.gz", "S1_kneaddata_paired_2.fastq.gz", "S1_kneaddata_single.fastq", "S1_kneaddata_single_unmatched_1.fastq",
        "S10_kneaddata_paired_1.fastq", "A_kneaddata_B_KNEADDATA_paired_1.fq", "A_kneaddata_B_kneaddata_paired_2.fq", "S5_kneaddata.log")
    wanted = samples(spark, "S1", "S10", "A", "A_kneaddata_B", "S5")
    got = {r.sample: r for r in manifests.cleaned_outputs(listing, wanted).collect()}
    assert {s: r.status for s, r in got.items()} == {"S1": "ok", "S10": "single_mate", "A": "ok", "A_kneaddata_B": "ok", "S5": "ok"}
    assert got["S1"].single == "d/S1_kneaddata_single.fastq" and got["S1"].unmatched_1 == "d/S1_kneaddata_single_unmatched_1.fastq"
    assert got["A"].paired_1 == got["A_kneaddata_B"].paired_1 == "d/A_kneaddata_B_KNEADDATA_paired_1.fq"
    existing = spark.createDataFrame([("m/A.joined.fastq.gz",)], "path string")
    plan = {r.sample: (r.action, len(r.inputs)) for r in manifests.concat_plan(manifests.cleaned_outputs(listing, wanted), existing, "m/").collect()}
    assert plan == {"S1": ("concat", 4), "S10": ("error", 1), "A": ("skip", 2), "A_kneaddata_B": ("concat", 2), "S5": ("error", 0)}


def test_cleanup_and_compression(spark):
    listing = files(spark, "S1_kneaddata_bowtie2_trimmed.fastq", "xS1_kneaddata.repeats", "S2_kneaddata_bowtie2", "S1_trimmed", "S1fastq", "S1_a.fastq", "S1_b.fastq.gz")
    assert {r.path for r in manifests.cleanup_plan(listing, samples(spark, "S1")).collect()} == {"d/S1_kneaddata_bowtie2_trimmed.fastq", "d/xS1_kneaddata.repeats"}
    assert {r.path for r in manifests.compression_plan(listing, samples(spark, "S1")).collect()} == {"d/S1_kneaddata_bowtie2_trimmed.fastq", "d/S1_a.fastq"}


def test_compression_equals_pattern(spark):
    rng = random.Random(3)
    names = sorted({"".join(rng.choice(["s", "1", "fastq", "_", "a"]) for _ in range(rng.randint(1, 6))) for _ in range(200)})
    wanted = ["s", "s1", "1s", "a_"]
    got = {r.path for r in manifests.compression_plan(files(spark, *names), samples(spark, *wanted)).collect()}
    assert got == {f"d/{n}" for n in names if any(re.search(re.escape(s) + ".+fastq", n) for s in wanted)}


def test_stage_plan(spark):
    db = "mpa_vOct22_CHOCOPhlAnSGB_202403"
    runs = files(spark, "S1_kneaddata.log", f"S1_{db}_RELAB_profile.tsv", f"S1_{db}_bowtie2.tsv", "S1_HM40_2_genefamilies.tsv", f"S2_{db}_RELAB_profile.tsv", "S2.joined.fastq.gz")
    plan = {(r.sample, r.stage): r.status for r in manifests.stage_plan(runs, samples(spark, "S1", "S2", "S3")).collect()}
    assert len(plan) == 21
    assert [plan["S1", s] for s in ("clean_paired", "clean_single", "concat", "relab_profile", "stats_profile", "genefamilies", "regroup_rename")] == [
        "done", "pending", "done", "done", "pending", "done", "pending"]
    assert (plan["S2", "relab_profile"], plan["S2", "concat"], plan["S3", "concat"]) == ("pending", "done", "pending")
    raw = manifests.raw_inputs(files(spark, "S1_1.fq", "S1_2.fq", "S2.fq"), samples(spark, "S1", "S2", "S3"))
    needed = {(r.sample, r.stage): r.status for r in manifests.stage_plan(runs, samples(spark, "S1", "S2", "S3"), raw).collect()}
    assert (needed["S1", "clean_single"], needed["S2", "clean_paired"], needed["S2", "clean_single"]) == ("not_needed", "not_needed", "pending")


def plain_states(have, stages, inputs):
    """State and first gap of every stage, by walking back from it."""
    def gaps(stage):
        out = set()
        for source in inputs[stage]:
            if source not in have:
                out |= {source} | (gaps(source) if source != "raw" else set())
        return out

    order = ["raw", *stages]
    found = {s: sorted(gaps(s), key=order.index) for s in stages}
    return {s: ("done", None) if s in have else ("blocked", found[s][0]) if found[s] else ("ready", None) for s in stages}


def test_ready_stages_of_random_runs(spark):
    db, other = "mpa_vOct22_CHOCOPhlAnSGB_202403", "db2"
    ends = {
        "clean_paired": ["_kneaddata.log"], "clean_single": ["_kneaddata_single.log"], "concat": [".joined.fastq.gz"],
        f"relab_profile:{db}": [f"_{db}_RELAB_profile.tsv", f"_{db}_bowtie2.tsv"], f"relab_profile:{other}": [f"_{other}_RELAB_profile.tsv", f"_{other}_bowtie2.tsv"],
        f"stats_profile:{db}": [f"_{db}_STATS_profile.tsv"], f"stats_profile:{other}": [f"_{other}_STATS_profile.tsv"],
        "genefamilies": ["_HM40_2_genefamilies.tsv"], "regroup_rename": [],
    }
    inputs = {
        "clean_paired": ["raw"], "clean_single": ["raw"], "concat": ["clean_paired", "clean_single"], f"relab_profile:{db}": ["concat"],
        f"relab_profile:{other}": ["concat"], f"stats_profile:{db}": [f"relab_profile:{db}"], f"stats_profile:{other}": [f"relab_profile:{other}"],
        "genefamilies": ["concat", f"relab_profile:{db}"], "regroup_rename": ["genefamilies"],
    }
    rng, names, raws, want = random.Random(5), [], [], {}
    for i in range(150):
        sample, kind = f"S{i:03d}", rng.choice(["pair", "orphan", "both", "one_mate", "nothing"])
        made = [e for group in ends.values() for e in group if rng.random() < 0.6]
        names += [sample + e for e in made]
        raws += [sample + e for e in {"pair": ["_1.fq", "_2.fq"], "orphan": [".fq"], "both": ["_1.fq", "_2.fq", ".fq"], "one_mate": ["_1.fq"], "nothing": []}[kind]]
        have = {s for s, group in ends.items() if group and set(group) <= set(made)}
        if {"genefamilies", f"relab_profile:{db}", f"relab_profile:{other}"} <= have:
            have.add("concat")
        skipped = {"pair": {"clean_single"}, "orphan": {"clean_paired"}}.get(kind, set())
        raw = {"raw"} if kind in ("pair", "orphan", "both") else set()
        states = plain_states(have | skipped | raw, list(ends), inputs)
        want |= {(sample, s): ("not_needed", None) if s in skipped else v for s, v in states.items()}
    ids = samples(spark, *[f"S{i:03d}" for i in range(150)])
    plan = manifests.ready_stages(files(spark, *names), ids, manifests.raw_inputs(files(spark, *raws), ids), dbs=(db, other))
    assert {(r.sample, r.stage): (r.state, r.missing) for r in plan.collect()} == want
    assert {v[0] for v in want.values()} == {"done", "ready", "blocked", "not_needed"}


def test_ready_stages_without_a_raw_manifest(spark):
    plan = manifests.ready_stages(files(spark, "S1_kneaddata.log"), samples(spark, "S1"))
    assert {r.stage: (r.state, r.missing) for r in plan.collect()} == {
        "clean_paired": ("done", None), "clean_single": ("ready", None), "concat": ("blocked", "clean_single"), "relab_profile": ("blocked", "clean_single"),
        "stats_profile": ("blocked", "clean_single"), "genefamilies": ("blocked", "clean_single"), "regroup_rename": ("blocked", "clean_single")}


def test_matching_files(spark):
    listing = files(spark, "S1_1.fq", "S1_2.fq", "S10_1.fq", "xS2")
    got = {r.sample: r.n_files for r in manifests.matching_files(listing, samples(spark, "S1", "S10", "S2", "S3")).collect()}
    assert got == {"S1": 3, "S10": 1, "S2": 1, "S3": 0}
    assert {r.sample for r in manifests.input_pair_errors(listing, samples(spark, "S1", "S10", "S3")).collect()} == {"S1", "S10", "S3"}


def test_regroup_and_names(spark):
    table = spark.createDataFrame(
        [("s", "UNMAPPED", 5.0), ("s", "U1", 3.0), ("s", "U1|g.x", 2.0), ("s", "U2", 1.0), ("s", "U3", 4.0), ("s", "U1|g.x", 1.5)],
        "sample string, feature string, value double")
    groups = spark.createDataFrame([("U1", "K1"), ("U1", "K2"), ("U2", "K1"), ("U2", "K1")], "feature string, grp string")
    got = {(r.grp, r.taxon): r.value for r in abundance.regroup(table, groups).collect()}
    assert got == {("UNMAPPED", None): 5.0, ("K1", None): 4.0, ("K2", None): 3.0, ("K1", "g.x"): 3.5, ("K2", "g.x"): 3.5, ("UNGROUPED", None): 4.0}
    names = spark.createDataFrame([("K1", "first")], "grp string, name string")
    labels = {r.grp for r in abundance.name_groups(abundance.regroup(table, groups), names).collect()}
    assert labels == {"UNMAPPED", "UNGROUPED", "K1: first", "K2: NO_NAME"}
