"""Lookups and link resolution on small records."""

import pytest
from pyspark.sql import functions as F

from sampleledger.operators import links, lookups


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("a", ["r1"]), ("b", ["r2", "r1"]), ("c", []), ("d", None)], "uid string, link array<string>"
    )


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([("r1", "one"), ("r2", "two")], "id string, name string")


def _map(df, value="name"):
    return {r.uid: r[value] for r in df.collect()}


def test_strict(rows, targets):
    assert {r.uid for r in links.multiple_links(rows, "link").collect()} == {"b", "c"}
    with pytest.raises(links.LinkError):
        links.resolve_links(rows, "link", targets)
    single = rows.filter("uid IN ('a', 'd')")
    assert _map(links.resolve_links(single, "link", targets)) == {"a": "one", "d": None}
    with pytest.raises(links.LinkError):
        links.resolve_links(single, "link", targets.filter("id = 'r2'"))


def test_plain_ids_resolve_as_links_of_one(spark, targets):
    plain = spark.createDataFrame([("a", "r1"), ("b", None)], "uid string, link string")
    assert _map(links.resolve_links(plain, "link", targets)) == {"a": "one", "b": None}
    assert _map(links.resolve_links(plain, "link", targets, strict=False)) == {"a": "one", "b": None}


def test_first_flat_and_all(rows, targets):
    assert _map(links.resolve_links(rows, "link", targets, strict=False)) == {"a": "one", "b": "two", "c": None, "d": None}
    flat = links.resolve_flat(rows, "link", targets)
    assert sorted((r.uid, r.pos, r.name) for r in flat.collect()) == [("a", 0, "one"), ("b", 0, "two"), ("b", 1, "one")]
    every = links.resolve_all(rows, "link", targets, "uid").collect()
    assert {r.uid: [x.name for x in r.linked] for r in every} == {"a": ["one"], "b": ["two", "one"], "c": [], "d": []}


def test_unpack_is_an_expression(rows, targets):
    last = links.resolve_links(rows, "link", targets, unpack=lambda c: F.try_element_at(c, F.lit(-1)), strict=False)
    assert _map(last) == {"a": "one", "b": "one", "c": None, "d": None}
    flat = links.resolve_links(rows, "link", targets, unpack=lambda c: F.reverse(c), strict=False)
    assert sorted((r.uid, r.pos, r.name) for r in flat.collect()) == [("a", 0, "one"), ("b", 0, "one"), ("b", 1, "two")]


def test_walk_keeps_missing_keep_and_repeats(spark):
    projects = spark.createDataFrame([("p1", "one"), ("p2", "two")], "id string, uid string")
    subjects = spark.createDataFrame(
        [("s1", "S1", 0, ["p1", "p2"]), ("s2", "S2", None, ["p1"]), ("s3", "S3", 1, None)],
        "id string, uid string, keep int, project array<string>",
    )
    specimens = spark.createDataFrame(
        [("b1", "B1", 1, ["s1"]), ("b2", "B2", 0, ["s2"]), ("b3", "B3", None, ["s2"])],
        "id string, uid string, keep int, subject array<string>",
    )
    preps = spark.createDataFrame(
        [("q1", "Q1", 1, ["b1"]), ("q2", "Q2", 0, ["b1"])], "id string, uid string, keep int, biospecimen array<string>"
    )
    members, owned = links.with_parents(subjects, "project"), links.with_parents(specimens, "subject")
    people = links.project_subjects(projects, members, "one")
    assert {r.uid for r in people.collect()} == {"S2"}
    everyone = links.project_subjects(projects, members, strict=False)
    assert sorted((r.project, r.uid) for r in everyone.collect()) == [("one", "S1"), ("one", "S2"), ("two", "S1")]
    found = links.project_biospecimens(projects, members, owned)
    assert sorted((r.project, r.uid) for r in found.collect()) == [("one", "B1"), ("one", "B3"), ("two", "B1")]
    got = links.biospecimen_seqpreps(found, links.with_parents(preps, "biospecimen"))
    by_links = spark.createDataFrame([("b1", 0, "q1"), ("b1", 1, "q2")], "parent_id string, pos int, child_id string")
    again = links.biospecimen_seqpreps(found, links.with_parents_by_links(by_links, preps))
    assert sorted(map(tuple, again.select("project", "uid").collect())) == sorted(map(tuple, got.select("project", "uid").collect()))
    assert sorted((r.project, r.biospecimen, r.uid) for r in got.collect()) == [("one", "B1", "Q1"), ("two", "B1", "Q1")]


def test_lookups(spark):
    recs = spark.createDataFrame([("T", "rec1", "a"), ("T", "rec2", "b"), ("U", "rec3", "a")], "tbl string, id string, uid string")
    one = recs.filter("tbl = 'T'")
    keys = lookups.key_rows(spark, ["b", "a", "zz", "b"])
    found = lookups.by_keys(one, keys).orderBy("pos").collect()
    assert [r.id for r in found] == ["rec2", "rec1", None, "rec2"]
    assert [r.key for r in lookups.missing_keys(keys, one).collect()] == ["zz"]
    with pytest.raises(lookups.MissingKey):
        lookups.require(lookups.by_uid(recs, "T", "zz"), "zz")
    projects = recs.select("uid", "id")
    lookups.check_project(projects, "a")
    with pytest.raises(lookups.MissingKey, match="zz") as wrong:
        lookups.check_project(projects, "zz")
    assert wrong.value.options.count() == 3
    assert [r.all_match for r in lookups.all_match(recs.limit(0), "uid", "x").collect()] == [True]


def test_visit_flags_and_unknown_ids(spark):
    subjects = spark.createDataFrame([("s1", "S1"), ("s2", "S2")], "id string, uid string")
    owned = spark.createDataFrame([("s1", "b1"), ("s1", "b2")], "parent_id string, child_id string")
    visited = spark.createDataFrame([("b1", "v1"), ("b1", "v2"), ("b2", "v9")], "parent_id string, child_id string")
    visits = spark.createDataFrame([("v1", "3mo"), ("v2", "1mo")], "id string, uid string")
    flags = links.visit_flags(subjects, owned, visited, visits, {"mo3": "3mo", "mo6": "6mo"})
    assert {r.uid: (r.mo3, r.mo6) for r in flags.collect()} == {"S1": (1, 0), "S2": (0, 0)}
    ids = spark.createDataFrame([("S1",), ("X",), (None,)], "ID string")
    joined = links.attach_flags(ids, flags, "ID", "uid", ["mo3"])
    assert {r.ID: r.mo3 for r in joined.collect()} == {"S1": 1, "X": 0, None: 0}
    assert links.repeated_flag_keys(flags, "uid").isEmpty()
    twice = flags.unionAll(flags.withColumn("mo3", F.lit(0)))
    assert {r.ID: r.mo3 for r in links.attach_flags(ids, twice, "ID", "uid", ["mo3"]).collect()} == {"S1": 1, "X": 0, None: 0}
    with pytest.raises(links.LinkError):
        links.attach_flags(ids, twice, "ID", "uid", ["mo3"], check=True)
