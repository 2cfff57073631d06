"""Registered queries against their SQL."""

import pytest

from tabula.llm.queries import QUERIES, SQL
from tabula.plans.oracle import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    out = compare(QUERIES[name](spark, SF), SQL[name], duckdb_connection(SF))
    assert out.ok, f"{name}: {out.detail}"
