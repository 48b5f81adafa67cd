"""Every registered query with SQL must give the rows DuckDB gives."""

import pytest

from compare import connect, differences, run_pair
from tagloom.plans.catalog import load_all

CATALOG = load_all()


@pytest.fixture(scope="module")
def duck(root):
    return connect(root)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql is not None])
def test_matches_sql(spark, duck, root, name):
    spark_rows, sql_rows = run_pair(spark, duck, root, CATALOG[name])
    assert differences(spark_rows, sql_rows)[:3] == []


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 3
    assert set(e.oracle_sql()) <= set(e.queries())
