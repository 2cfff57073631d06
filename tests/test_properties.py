"""Layer 3: invariants that must hold for any input."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabula.operators import chartdata as V
from tabula.operators import stats as ST

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=1, max_size=60)


@SETTINGS
@given(vals=values, nbins=st.integers(1, 12))
def test_histogram_counts_sum_to_non_null(spark, vals, nbins):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    non_null = sum(v is not None for v in vals)
    rows = ST.histogram(df, "v", nbins).collect()
    if non_null == 0:
        assert rows == []
    else:
        assert len(rows) == nbins
        assert sum(r["count"] for r in rows) == non_null


@SETTINGS
@given(n=st.integers(1, 300), w=st.floats(0.1, 0.9), seed=st.integers(0, 1000))
def test_random_split_parts_add_up(spark, n, w, seed):
    df = spark.range(n)
    a, b = ST.random_split(df, [w, 1 - w], seed)
    inv = ST.split_report(df, a, b).first()
    assert inv.n_overlap == 0 and inv.n_union == n == inv.n_first + inv.n_second


@SETTINGS
@given(n=st.integers(1, 200), frac=st.floats(0.05, 0.95), seed=st.integers(0, 1000))
def test_sample_and_except_are_disjoint(spark, n, frac, seed):
    df = spark.range(n).selectExpr("id % 50 as k")
    train, test = ST.split_by_except(df, frac, seed)
    inv = ST.split_report(df, train, test).first()
    assert inv.n_overlap == 0
    assert inv.n_union == min(n, 50)


@SETTINGS
@given(vals=st.lists(st.floats(-100, 100, allow_nan=False), min_size=4, max_size=50))
def test_box_whiskers_inside_fences(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = V.box_stats(df, "v").first()
    # whiskers are data points inside the fences (they may fall inside the
    # box when the quartiles are interpolated between data points)
    assert b.q1 <= b.median <= b.q3
    assert b.lower_fence <= b.whisker_low <= b.whisker_high <= b.upper_fence
    assert b.whisker_low in vals and b.whisker_high in vals
    outside = sum(v < b.lower_fence or v > b.upper_fence for v in vals)
    assert b.n_outliers == outside


@SETTINGS
@given(vals=st.lists(st.integers(0, 20), min_size=2, max_size=60),
       probs=st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_quantile_methods_agree_on_small_data(spark, vals, probs):
    import numpy as np
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    exact = [r.value for r in ST.quantiles(df, ["v"], probs, method="exact").collect()]
    assert exact == pytest.approx(list(np.percentile(vals, [p * 100 for p in probs])))
    disc = [r.value for r in ST.quantiles(df, ["v"], probs, method="disc").collect()]
    approx = [r.value for r in ST.quantiles(df, ["v"], probs, method="approx",
                                            accuracy=1_000_000).collect()]
    assert disc == approx
