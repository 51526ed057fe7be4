"""The driver contract: the training-data part is optional, the analytics part is not."""

import importlib
import sys

import pytest


def _entry_without(monkeypatch, *missing):
    """``__spark_entry__`` as it is where these modules cannot be imported."""

    class Refuses:
        def find_spec(self, name, path=None, target=None):
            if name in missing:
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in list(sys.modules):
        if name.startswith(("finlake.llm", "corpus_pipeline", "__spark_entry__")) or name in missing:
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Refuses(), *sys.meta_path])
    return importlib.import_module("__spark_entry__")


@pytest.mark.parametrize("missing", ["finlake.llm", "zstandard"])
def test_analytics_queries_stay_without_the_training_data_part(monkeypatch, missing):
    if missing == "zstandard":
        pytest.importorskip("finlake.llm")
        with pytest.warns(UserWarning, match="zstandard"):
            entry = _entry_without(monkeypatch, missing)
    else:
        entry = _entry_without(monkeypatch, "finlake.llm", "finlake.llm.queries", "corpus_pipeline")
    names = entry.queries()
    assert "silver_daily_usage" in names and not any(n.startswith("op") for n in names)
    assert set(entry.oracle_sql()) <= set(names)


def test_a_missing_part_of_the_analytics_package_is_an_error(monkeypatch):
    import __spark_entry__ as entry

    def missing(name):
        raise ModuleNotFoundError("gone", name="finlake.plans.jobs")

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    with pytest.raises(ModuleNotFoundError):
        entry._optional("finlake.llm.queries")


def test_every_analytics_query_has_sql():
    import __spark_entry__ as entry

    core = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert core <= set(entry.oracle_sql())
