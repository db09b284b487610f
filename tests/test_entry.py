"""The driver's contract, also where the training-data operators are taken out."""

import importlib
import sys

import __spark_entry__
from sampleledger import catalog


def test_every_catalogued_query_is_registered():
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(catalog.oracle_sql()) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_everything_else_works_without_them(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("sampleledger.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        # a module entry of None makes the import fail as for a deleted file
        entry = importlib.reload(__spark_entry__)
        assert set(entry.queries()) == set(catalog.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
