import pytest

from termloom import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(name, same):
    same(catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_runs(name, spark, data):
    df = catalog.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)


def test_entry_and_queries(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_does_not_import_llm():
    import os
    import re

    import termloom

    top = os.path.dirname(termloom.__file__)
    for folder, _, names in os.walk(top):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as f:
                    assert not re.search(r"^\s*(?:from|import) termloom\.llm", f.read(), re.M), n
