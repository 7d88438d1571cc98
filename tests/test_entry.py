"""The core queries are registered whatever the training-data subpackage lacks."""

import importlib
import sys
import warnings

import pytest

from tidemark.plans.catalog import REGISTRY


def entry_without(monkeypatch, missing):
    """The entry module, imported anew where ``missing`` can't be imported."""
    for name in list(sys.modules):
        if name in ("__spark_entry__", "corpus_pipeline") or name.startswith("tidemark.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        module = importlib.import_module("__spark_entry__")
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    return module, [str(w.message) for w in said]


@pytest.mark.parametrize("missing", ["tidemark.llm", "tidemark.llm.queries", "corpus_pipeline", "public_tokenizers", "regex", "xxhash",
                                     "tokenizers", "zstandard"])
def test_core_queries_stand_alone(monkeypatch, missing):
    before = list(sys.path)
    module, said = entry_without(monkeypatch, missing)
    sys.path[:] = before
    names = set(module.queries())
    assert set(REGISTRY) <= names
    if names == set(REGISTRY):
        assert any("left out" in text for text in said)
        assert set(module.oracle_sql()) == {n for n, q in REGISTRY.items() if q.oracle is not None}
