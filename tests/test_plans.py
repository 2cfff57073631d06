"""Physical-plan properties that the design relies on at scale."""

import io
import re
from contextlib import redirect_stdout

import pytest

from tabula.plans.catalog import all_queries

from .conftest import SF_SMALL

QUERIES = {name: q.fn for name, q in all_queries().items()}


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_cartesian_products(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p]
    assert not bad, bad


def test_nested_loop_joins_only_attach_small_sides(plans):
    # a nested-loop join is allowed only as the broadcast of a one-row
    # aggregate or a generated grid: its build side is always broadcast
    for name, p in plans.items():
        for m in re.finditer(r"BroadcastNestedLoopJoin (\w+) Build(\w+)", p):
            assert m.group(1) in ("Cross", "Inner"), (name, m.group(0))


def test_filters_and_projection_reach_the_scan(plans):
    p = plans["filter_or"]
    assert "Or(EqualTo(o_orderstatus,F),EqualTo(o_orderstatus,O))" in p
    assert "GreaterThan(o_totalprice,20000.0)" in p
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plans["select_cols"])
    assert schemas == ["l_orderkey:bigint,l_partkey:bigint,l_quantity:double"]
    assert "EqualTo(l_returnflag,R)" in plans["hexbin_subset"]


def test_fact_table_joins_are_sort_merge(plans):
    for name in ("bucket_means", "join_drop_key", "months_days_between"):
        assert "SortMergeJoin" in plans[name], name


def test_aggregations_are_partial_before_the_shuffle(plans):
    for name in ("heat_mean", "group_means", "cube_avg", "count_distinct"):
        p = plans[name].split("\n\n")[0]
        assert p.count("HashAggregate") >= 2 and "Exchange" in p, name


def test_no_row_at_a_time_python(plans):
    # user code runs in Arrow batches only
    bad = [n for n, p in plans.items() if "BatchEvalPython" in p or "PythonUDF" in p]
    assert not bad, bad
