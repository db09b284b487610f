"""The record base on a folder of snapshots."""

import json

import pytest

from sampleledger.base import RecordBase
from sampleledger.fixed import RECORD_TABLES
from sampleledger.operators import audit, lookups, reports
from sampleledger.sources import records


def _id(kind, n):
    return f"rec{kind}{n:013d}"


RECORDS = {
    "Projects": [("P", 1, {"uid": "one", "Subjects": [_id("S", 1), _id("S", 2)]}), ("P", 2, {"uid": "two", "Subjects": [_id("S", 1)]}), ("P", 3, {"uid": "empty"})],
    "Subjects": [
        ("S", 1, {"uid": "0001", "keep": 1, "project": [_id("P", 1), _id("P", 2)], "Biospecimens": [_id("B", 1), _id("B", 2)]}),
        ("S", 2, {"uid": "0002", "keep": 0, "project": [_id("P", 1)], "Biospecimens": [_id("B", 3)]}),
    ],
    "Biospecimens": [
        ("B", 1, {"uid": "FG1", "keep": True, "subject": [_id("S", 1)], "seqprep": [_id("Q", 1), _id("Q", 2)], "visit": [_id("V", 1)]}),
        ("B", 2, {"uid": "FG2", "keep": False, "subject": [_id("S", 1)], "seqprep": [_id("Q", 3)]}),
        ("B", 3, {"uid": "FG3", "subject": [_id("S", 2)]}),
    ],
    "SequencingPrep": [
        ("Q", 1, {"uid": "SEQ1", "keep": 1, "biospecimen": [_id("B", 1)], "S_well": "S1", "sequencing_batch": ["b1"], "kneaddata": True}),
        ("Q", 2, {"uid": "SEQ2", "keep": 0, "biospecimen": [_id("B", 1)], "S_well": "S2", "sequencing_batch": "b1"}),
        ("Q", 3, {"uid": "SEQ3", "biospecimen": [_id("B", 2)]}),
    ],
    "Visits": [("V", 1, {"uid": "3mo"})],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("snapshots")
    for table in RECORD_TABLES:
        rows = [{"id": _id(k, n), "fields": f} for k, n, f in RECORDS.get(table, [("X", 0, {"uid": "x"})])]
        (path / records.snapshot_name(table)).write_text(json.dumps(rows))
    return str(path)


@pytest.fixture(scope="module", params=[False, True], ids=["links", "back links"])
def base(spark, folder, request):
    return RecordBase.load(spark, folder, back_links=request.param, fmt="array")


def test_walks(base):
    assert sorted(r.uid for r in base.subjects("one", strict=False).collect()) == ["0001", "0002"]
    assert [r.uid for r in base.subjects("one").collect()] == ["0001"]
    assert sorted((r.project, r.uid) for r in base.subjects().collect()) == [("one", "0001"), ("two", "0001")]
    assert sorted((r.project, r.subject, r.uid) for r in base.biospecimens("one").collect()) == [("one", "0001", "FG1"), ("one", "0002", "FG3")]
    assert sorted((r.biospecimen, r.uid, r.s_well) for r in base.seqpreps("one").collect()) == [("FG1", "SEQ1", "S1")]
    assert sorted(r.uid for r in base.seqpreps("two", strict=False).collect()) == ["SEQ1", "SEQ2", "SEQ3"]
    assert base.biospecimens("empty").isEmpty()
    with pytest.raises(lookups.MissingKey):
        base.subjects("three")


def test_indexing(spark, base):
    assert base["Subjects"].count() == 2
    assert base["Projects", "two"].first().id == _id("P", 2)
    assert base[_id("B", 2)].first().uid == "FG2"
    assert _id("B", 2) in base and "Sites" in base and _id("B", 99) not in base
    assert base.get(_id("B", 99)) is None
    with pytest.raises(lookups.MissingKey):
        base["Projects", "three"]
    keys = lookups.key_rows(spark, ["FG2", _id("B", 1), "FG2"])
    assert [r.uid for r in base.many("Biospecimens", keys).orderBy("pos").collect()] == ["FG2", "FG1", "FG2"]
    with pytest.raises(lookups.MissingKey):
        base.many("Biospecimens", lookups.key_rows(spark, ["FG9"]))
    assert {r.uid for r in base.matching("Biospecimens", "G[12]").collect()} == {"FG1", "FG2"}
    assert {r.uid for r in base.uids("Visits").collect()} == {"3mo"}


def test_resolve_over_all_tables(base):
    visits = base.resolve_links(base.typed("Biospecimens"), "visit")
    assert {r.uid: (r.linked_tbl, r.linked_uid) for r in visits.collect()} == {"FG1": ("Visits", "3mo"), "FG2": (None, None), "FG3": (None, None)}


@pytest.mark.parametrize("keep", [False, True])
def test_audit(spark, base, tmp_path, keep):
    rows = [("a", "SEQ1", "S1", "kneaddata.log"), ("b", "SEQ1", "S1", "odd"), ("c", "SEQ3", "S1", "profile.tsv"), ("d", None, None, None)]
    listing = spark.createDataFrame(rows, "path string, seqprep string, s_well string, suffix string")
    result = base.audit(listing, keep)
    assert {r.uid for r in result.remote_seq.collect()} == {"SEQ1", "SEQ2"}
    assert [(r.seqprep, r.kneaddata_complete) for r in result.local_seq.collect()] == [("SEQ1", True)]
    assert {r.path for r in result.good_files.collect()} == {"a"} and {r.path for r in result.problem_files.collect()} == {"b", "c", "d"}
    counts = {r.thing: (r.n_local, r.n_remote, r["diff"]) for r in reports.audit_report(result)["counts"].collect()}
    assert counts["sequences"] == (1, 2, -1) and counts["kneaddata"] == (1, 1, 0)
    audit.write_split(audit.flag_files(listing, result.remote_seq), str(tmp_path / "split"))
    back = spark.read.parquet(str(tmp_path / "split"))
    assert {r.path: r.kind for r in back.collect()} == {"a": "good", "b": "problem", "c": "problem", "d": "problem"}


def test_fields_that_no_schema_names_survive_walks(spark):
    specimens = [
        ("B", 1, {"uid": "FG1", "subject": [_id("S", 1)], "depth": 3, "Keep": "yes", "project": [_id("P", 9)], "note": "a", "id": "inner", "box": {"row": 1}}),
        ("B", 2, {"uid": "FG2", "subject": [_id("S", 1)], "depth": 2.5, "note": 7, "tags": ["x", "y"], "nothing": None, "odd 'name'.x": True}),
        ("B", 3, {"uid": "FG3", "subject": [_id("S", 2)]}),
    ]
    lines = {t: spark.createDataFrame([(json.dumps({"id": _id(k, n), "fields": f}),) for k, n, f in rows], "value string") for t, rows in {**RECORDS, "Biospecimens": specimens}.items()}
    base = RecordBase(records.base_of(lines), all_fields=True)
    found = {r["uid"]: r for r in base.biospecimens("one").collect()}
    kinds = dict(base.biospecimens("one").dtypes)
    assert kinds["note"] == kinds["box"] == "variant" and kinds["tags"] == "array<string>" and kinds["depth"].startswith("decimal")
    assert float(found["FG1"]["depth"]) == 3 and float(found["FG2"]["depth"]) == 2.5 and found["FG3"]["depth"] is None
    assert found["FG1"]["Keep_field"] == "yes" and found["FG1"]["id_field"] == "inner" and found["FG1"]["project"] == "one"
    assert found["FG1"]["note"].toPython() == "a" and found["FG2"]["note"].toPython() == 7 and found["FG1"]["box"].toPython() == {"row": 1}
    assert found["FG2"]["tags"] == ["x", "y"] and found["FG2"]["odd 'name'.x"] is True and found["FG2"]["nothing"] is None
    mixed = {(r["tbl"], r["field"]): r["kinds"] for r in records.mixed_fields(base.records()).collect()}
    assert mixed == {("Biospecimens", "note"): ["BIGINT", "STRING"], ("SequencingPrep", "sequencing_batch"): ["ARRAY", "STRING"]}
