"""Layer 1: every registered query against its DuckDB twin (sf0.001)."""

import os

import pytest

import __spark_entry__ as entry
from tabula.plans.catalog import all_queries
from tabula.plans.oracle import compare, duckdb_connection

from .conftest import SF_SMALL

SF = os.environ.get("TABULA_TEST_SF", SF_SMALL)
QUERIES = {name: q.fn for name, q in all_queries().items()}
SQL = {name: q.sql for name, q in all_queries().items() if q.sql}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    out = compare(QUERIES[name](spark, SF), SQL[name], con)
    assert out.ok, f"{name}: {out.detail}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_every_query_has_survey_ids():
    for name, q in all_queries().items():
        assert q.ids, name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"range", "c_mktsegment", "l_extendedprice_avg", "range_order"}


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
