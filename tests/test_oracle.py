"""Every query with a SQL twin must equal DuckDB on sf0.01 (row count,
column names, order-insensitive values); the others must run."""

import pytest

from tables import SF_CHECK, SF_SMALL
from portrait.plans.check import compare, duckdb_conn
from portrait.plans.oracle import ORACLE_SQL
from portrait.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_CHECK)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, con, key):
    r = compare(QUERIES[key](spark, SF_CHECK), con, ORACLE_SQL[key])
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r
    assert r["types_match"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_model_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["user_id", "feature", "apps", "n_apps"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
