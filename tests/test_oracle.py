"""Every catalogue query equals its DuckDB statement on the small tables."""

import pytest

import __spark_entry__ as entry
from finlake.plans import registry
from finlake.plans.verify import compare, duckdb_connection

SQL = registry.oracle_sql()
QUERIES = registry.queries()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, name, QUERIES[name], SQL[name], sf_dir, con)
    assert r.ok, r.detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "daily_cost_usd" in df.columns
