import importlib
import sys

import pytest


def test_every_query_runs_on_the_small_tables(spark, sf):
    import __spark_entry__ as e

    core = [n for n in e.queries() if e.queries()[n].__module__ in ("siltstone.queries", "siltstone.domain_queries", "siltstone.catalog_queries")]
    assert len(core) > 50
    for name in core:
        df = e.queries()[name](spark, sf)
        assert len(set(df.columns)) == len(df.columns), name
        df.write.format("noop").mode("overwrite").save()
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_the_text_package(monkeypatch):
    for m in [m for m in sys.modules if m.startswith("siltstone.llm") or m == "__spark_entry__"]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "siltstone.llm", None)
    import siltstone

    monkeypatch.delattr(siltstone, "llm", raising=False)
    e = importlib.import_module("__spark_entry__")
    assert "p1_found" in e.queries() and "p4_found" not in e.queries() and "p4_found" not in e.oracle_sql()
    sys.modules.pop("__spark_entry__")


@pytest.mark.parametrize("name", ["p2_found", "p5_found"])
def test_columns(spark, sf, name):
    import __spark_entry__ as e

    want = {"p2_found": ["tab", "row_key", "period", "reason"], "p5_found": ["tab", "seq", "child", "creator_pos", "item_pos"]}
    assert e.queries()[name](spark, sf).columns == want[name]
