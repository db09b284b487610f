"""Profiles and functional tables from real files, split anywhere."""

import random

import pytest

from sampleledger.plans import abundance
from sampleledger.sources import abundance_tables


@pytest.fixture
def tables(tmp_path):
    rng, want, bad = random.Random(6), [], []

    def write(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")

    for n in range(3):
        lines = [f"# Gene Family\tFG{n}_S9_Abundance-RPKs"]
        for i in range(400):
            feature, value = f"UniRef90_{i}" + rng.choice(["", "|g__Dorea.s__x", "|unclassified"]), rng.random() * 1e6
            lines.append(f"{feature}\t{value!r}")
            want.append((f"FG{n}_genefamilies.tsv", f"FG{n}_S9", feature, value, None))
        write(f"FG{n}_genefamilies.tsv", lines)
    columns = "#clade_name\tNCBI_tax_id\trelative_abundance\tadditional_species"
    lines = ["#mpa_v30_CHOCOPhlAn_201901", "#/x/bin/metaphlan a.fastq --nproc 8", "#SampleID\tMetaphlan_Analysis", columns]
    for i in range(300):
        lines.append(f"k__B{i}\t{i}|{i}\t{i / 7!r}" + rng.choice(["", "\t", "\tx,y"]))
        want.append(("C0477-5F-1A_S89_profile.tsv", "C0477-5F-1A_S89", f"k__B{i}", i / 7, "mpa_v30_CHOCOPhlAn_201901"))
    write("C0477-5F-1A_S89_profile.tsv", lines)
    write("joined.tsv", ["# Pathway\ta_Abundance\tb_Coverage", "P1\t1\t2", "", "P2\t3", "P3\t4\tno"])
    want += [("joined.tsv", "a", "P1", 1.0, None), ("joined.tsv", "b", "P1", 2.0, None)]
    write("none.tsv", ["P1\t1"])
    write("two.tsv", ["# Gene Family\ta", "# Gene Family\tb", "P1\t1"])
    write("empty.tsv", ["#clade_name\tNCBI_tax_id\trelative_abundance"])
    bad = [("joined.tsv", "P2\t3", "cells"), ("joined.tsv", "P3\t4\tno", "value"), ("none.tsv", "P1\t1", "header"), ("two.tsv", "P1\t1", "header")]
    return str(tmp_path), want, bad


@pytest.mark.parametrize("split", [128 << 20, 700])
def test_each_row_has_the_header_of_its_file(spark, tables, split):
    folder, want, bad = tables
    names = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        lines = abundance_tables.table_lines(spark, folder)
        assert split > 1000 or lines.rdd.getNumPartitions() >= 8
        found = [(r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in abundance_tables.abundances(lines).collect()]
        rejected = [(r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in abundance_tables.rejected_rows(lines).collect()]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert sorted(found, key=str) == sorted(want, key=str) and sorted(rejected) == sorted(bad)


def test_read_tables_are_regrouped(spark, tables):
    table = abundance_tables.abundances(abundance_tables.table_lines(spark, tables[0] + "/joined.tsv"))
    groups = spark.createDataFrame([("P1", "K1")], "feature string, grp string")
    assert {(r["sample"], r["grp"], r["value"]) for r in abundance.regroup(table, groups).collect()} == {("a", "K1", 1.0), ("b", "K1", 2.0)}
