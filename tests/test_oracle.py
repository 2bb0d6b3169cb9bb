"""Every registered query with a SQL twin equals DuckDB on the small tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare

SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    r = compare(spark, duck, name, E.queries()[name], SQL[name], SF_SMALL)
    assert r["ok"], r


def test_every_query_is_named_and_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 90


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_predictions"] > 0
