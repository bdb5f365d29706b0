"""The driver contract holds with and without the training-data operators."""

import importlib
import sys

from tablewright.plans.catalog import REGISTRY


def entry_module():
    sys.modules.pop("__spark_entry__", None)
    return importlib.import_module("__spark_entry__")


def test_entry_without_the_operators(monkeypatch):
    # None in sys.modules makes an import fail as a missing module does
    for name in ("tablewright.llm", "tablewright.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    entry = entry_module()
    assert set(entry.queries()) == set(REGISTRY) == set(entry.oracle_sql())
    sys.modules.pop("__spark_entry__")


def test_every_oracle_belongs_to_a_query(spark):
    entry = entry_module()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
