"""Layer 2: edge cases of the operators on literal frames."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.functions import dates as D
from tabula.functions import scalar as X
from tabula.operators import chartdata as V
from tabula.operators import columns as C
from tabula.operators import groups as G
from tabula.operators import joins as J
from tabula.operators import setops as S
from tabula.operators import stats as ST
from tabula.plans import strategy

# The 32-row car table (public R data set) and the four
# correlations printed in the recipe's comments.
CARS = """\
21.0,6,160.0,110,3.90,2.620,16.46,0,1,4,4
21.0,6,160.0,110,3.90,2.875,17.02,0,1,4,4
22.8,4,108.0,93,3.85,2.320,18.61,1,1,4,1
21.4,6,258.0,110,3.08,3.215,19.44,1,0,3,1
18.7,8,360.0,175,3.15,3.440,17.02,0,0,3,2
18.1,6,225.0,105,2.76,3.460,20.22,1,0,3,1
14.3,8,360.0,245,3.21,3.570,15.84,0,0,3,4
24.4,4,146.7,62,3.69,3.190,20.00,1,0,4,2
22.8,4,140.8,95,3.92,3.150,22.90,1,0,4,2
19.2,6,167.6,123,3.92,3.440,18.30,1,0,4,4
17.8,6,167.6,123,3.92,3.440,18.90,1,0,4,4
16.4,8,275.8,180,3.07,4.070,17.40,0,0,3,3
17.3,8,275.8,180,3.07,3.730,17.60,0,0,3,3
15.2,8,275.8,180,3.07,3.780,18.00,0,0,3,3
10.4,8,472.0,205,2.93,5.250,17.98,0,0,3,4
10.4,8,460.0,215,3.00,5.424,17.82,0,0,3,4
14.7,8,440.0,230,3.23,5.345,17.42,0,0,3,4
32.4,4,78.7,66,4.08,2.200,19.47,1,1,4,1
30.4,4,75.7,52,4.93,1.615,18.52,1,1,4,2
33.9,4,71.1,65,4.22,1.835,19.90,1,1,4,1
21.5,4,120.1,97,3.70,2.465,20.01,1,0,3,1
15.5,8,318.0,150,2.76,3.520,16.87,0,0,3,2
15.2,8,304.0,150,3.15,3.435,17.30,0,0,3,2
13.3,8,350.0,245,3.73,3.840,15.41,0,0,3,4
19.2,8,400.0,175,3.08,3.845,17.05,0,0,3,2
27.3,4,79.0,66,4.08,1.935,18.90,1,1,4,1
26.0,4,120.3,91,4.43,2.140,16.70,0,1,5,2
30.4,4,95.1,113,3.77,1.513,16.90,1,1,5,2
15.8,8,351.0,264,4.22,3.170,14.50,0,1,5,4
19.7,6,145.0,175,3.62,2.770,15.50,0,1,5,6
15.0,8,301.0,335,3.54,3.570,14.60,0,1,5,8
21.4,4,121.0,109,4.11,2.780,18.60,1,1,4,2"""
CAR_COLS = "mpg cyl disp hp drat wt qsec vs am gear carb".split()
CAR_CORR_VS = {"mpg": 0.6640389, "disp": -0.7104159, "hp": -0.7230967, "wt": -0.5549157}


@pytest.fixture(scope="module")
def cars(spark):
    rows = [tuple(float(x) for x in line.split(",")) for line in CARS.splitlines()]
    return spark.createDataFrame(rows, CAR_COLS)


def test_car_correlations_match_recipe(cars):
    for col, want in CAR_CORR_VS.items():
        got = ST.corr_pair(cars, "vs", col).first()["corr"]
        assert round(got, 7) == pytest.approx(want, abs=1e-7)


def test_corr_matrix_long_form(cars):
    cols = ["vs", "mpg", "disp", "hp", "wt"]
    m = {(r.var1, r.var2): r.value for r in ST.corr_matrix(cars, cols, digits=2).collect()}
    assert len(m) == 25
    assert m[("vs", "vs")] == 1.0
    assert m[("vs", "mpg")] == m[("mpg", "vs")] == 0.66
    assert m[("vs", "hp")] == -0.72


def _gaps(spark):
    return spark.createDataFrame(
        [(1, None, 1.0), (2, "", float("nan")), (3, "a", None), (4, "b", 2.0)],
        "k long, s string, x double")


def test_null_nan_empty_are_distinct(spark):
    g = _gaps(spark)
    assert sorted(r.k for r in g.where(C.not_nan("x")).collect()) == [1, 3, 4]
    assert sorted(r.k for r in g.where(C.non_empty("s")).collect()) == [3, 4]
    assert sorted(r.k for r in C.drop_missing(g, "any").collect()) == [4]
    filled = {r.k: (r.s, r.x) for r in C.fill_missing(g, 12345).collect()}
    assert filled[1] == (None, 1.0) and filled[2] == ("", 12345.0) and filled[3] == ("a", 12345.0)
    rep = {r.k: r.s for r in C.replace_blank(g, "s", "Unknown").collect()}
    assert rep == {1: None, 2: "Unknown", 3: "a", 4: "b"}
    nulls = {r.column: r.nulls for r in C.null_counts(g).collect()}
    assert nulls == {"k": 0, "s": 1, "x": 1}


def test_dropna_thresh_and_all(spark):
    g = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert C.drop_missing(g, how="all").count() == 2
    assert C.drop_missing(g, min_non_nulls=2).count() == 1


def test_range_buckets_faithful_vs_gapfree(spark):
    df = spark.createDataFrame([(40.5,), (81.0,), (29.0,), (None,), (75.0,), (30.0,)], "v double")
    rows = df.select("v", X.range_bucket("v").alias("g"),
                     X.range_bucket("v", "faithful").alias("f")).collect()
    got = {r.v: (r.g, r.f) for r in rows}
    assert got[40.5] == ("30-40", "<30")
    assert got[81.0] == (">70", "<30")
    assert got[29.0] == ("<30", "<30")
    assert got[None] == (None, "<30")
    assert got[75.0] == (">70", ">70")
    assert got[30.0] == ("30-40", "30-40")
    order = df.select(X.range_bucket_order(X.range_bucket("v")).alias("o")).collect()
    assert sorted(r.o for r in order if r.o is not None) == [0, 1, 1, 5, 5]


def test_histogram_constant_and_empty_bins(spark):
    const = spark.createDataFrame([(5.0,)] * 4 + [(None,)], "v double")
    h = ST.histogram(const, "v", 3).collect()
    assert len(h) == 3 and sum(r["count"] for r in h) == 4
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == [4, 0, 0]
    gap = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "v double")
    h = sorted(ST.histogram(gap, "v", 5).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in h] == [2, 0, 0, 0, 1]
    assert h[0].lower == 0.0 and h[-1].upper == 10.0
    assert h[0].centroid == pytest.approx(1.0)


def test_bivariate_histogram_bins(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (10.0, 5.0)], "x double, y double")
    out = {(r.x_bin, r.y_bin): r["count"] for r in ST.bivariate_histogram(df, "x", "y", 10).collect()}
    # x edges floor(1)..ceil(10) in 10 points → width 1; y constant → bin 1
    assert out == {(1, 1): 2, (9, 1): 1}


def test_except_is_distinct_and_split_is_disjoint(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "a int")
    b = spark.createDataFrame([(3,)], "a int")
    assert sorted(r.a for r in S.except_rows(df, b).collect()) == [1, 2]
    train, test = ST.split_by_except(df, 0.5, seed=1)
    inv = ST.split_report(df, train, test).first()
    assert inv.n == 4 and inv.n_overlap == 0 and inv.n_union == 3


def test_merge_suffixes_all_clashes(spark):
    a = spark.createDataFrame([(1, "x", 10)], "k int, name string, v int")
    b = spark.createDataFrame([(1, "y", 20)], "k int, name string, w int")
    out = J.merge(a, b, "k")
    assert out.columns == ["k_x", "name_x", "v", "k_y", "name_y", "w"]
    assert out.first().asDict() == {"k_x": 1, "name_x": "x", "v": 10, "k_y": 1, "name_y": "y", "w": 20}


def test_append_checks_and_fill(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    with pytest.raises(ValueError):
        S.append_rows(a, b)
    assert S.append_rows(a, b, check_order=False).count() == 2
    c = spark.createDataFrame([(3, 1.5)], "k int, z double")
    filled = S.append_fill(a, c)
    assert filled.columns == ["k", "s", "z"]
    rows = {r.k: (r.s, r.z) for r in filled.collect()}
    assert rows == {1: ("x", None), 3: (None, 1.5)}
    texty = {r.k: r.s for r in S.append_fill(a, c, fill="").collect()}
    assert texty == {1: "x", 3: ""}
    assert S.append_common(a, c).columns == ["k"]


def test_dates_and_bad_text(spark):
    df = spark.createDataFrame([("01/31/2024", "2024-12-30"), ("13/45/2024", "not a date")],
                               "us string, iso string")
    rows = df.select(D.parse_date("us").alias("d"), D.parse_iso_date("iso").alias("i")).collect()
    assert rows[0].d == dt.date(2024, 1, 31) and rows[1].d is None and rows[1].i is None
    one = df.limit(1).select(
        D.shift_months(D.parse_date("us"), 1).alias("m"),
        D.next_weekday(D.parse_iso_date("iso"), "Sunday").alias("n"),
        D.date_parts(D.parse_iso_date("iso"))["week_of_year"].alias("w"),
        D.months_between(F.lit(dt.date(2024, 3, 31)), F.lit(dt.date(2024, 2, 29))).alias("mb"),
        D.days_between(F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2024, 2, 1))).alias("db"),
        D.period_start(D.parse_iso_date("iso"), "month").alias("p")).first()
    assert one.m == dt.date(2024, 2, 29)
    assert one.n == dt.date(2025, 1, 5)
    assert one.w == 1
    assert one.mb == 1.0
    assert one.db == 29
    assert one.p == dt.date(2024, 12, 1)


def test_cube_grouping_id_separates_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 3.0)], "k string, v double")
    out = G.cube_agg(df, ["k"], {"s": F.sum("v")}).collect()
    got = {(r.k, r.grouping_id): r.s for r in out}
    assert got == {(None, 0): 1.0, ("a", 0): 3.0, (None, 1): 4.0}


def test_crosstab_fills_zero(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "p string, q string")
    out = {r["p_q"]: (r.x, r.y) for r in ST.crosstab(df, "p", "q", ["x", "y"]).collect()}
    assert out == {"a": (1, 1), "b": (1, 0)}


def test_box_stats_match_numpy(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = V.box_stats(df, "v", notch=True).first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (b.q1, b.median, b.q3) == (q1, med, q3)
    iqr = q3 - q1
    assert b.whisker_high == max(v for v in vals if v <= q3 + 1.5 * iqr)
    assert b.n_outliers == 1
    assert b.notch_low == pytest.approx(med - 1.58 * iqr / math.sqrt(len(vals)))
    out = V.box_outliers(df, "v").collect()
    assert [r.v for r in out] == [100.0]


def test_density_integrates_to_about_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=400)], "v double")
    d = sorted(V.density_1d(df, "v", n=256).collect(), key=lambda r: r.x)
    xs = np.array([r.x for r in d])
    ys = np.array([r.density for r in d])
    area = float(np.sum((ys[1:] + ys[:-1]) / 2 * np.diff(xs)))
    assert 0.9 < area <= 1.0


def test_density_2d_matches_bruteforce(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(60, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "x double, y double")
    out = V.density_2d(df, "x", "y", n=5, h=(1.0, 2.0), bins=None).collect()
    hx, hy = 0.25, 0.5
    gx = np.linspace(pts[:, 0].min(), pts[:, 0].max(), 5)
    gy = np.linspace(pts[:, 1].min(), pts[:, 1].max(), 5)
    for r in out:
        kx = np.exp(-0.5 * ((gx[r.i] - pts[:, 0]) / hx) ** 2)
        ky = np.exp(-0.5 * ((gy[r.j] - pts[:, 1]) / hy) ** 2)
        want = np.sum(kx * ky) / (len(pts) * hx * hy * 2 * math.pi)
        assert r.density == pytest.approx(want, rel=1e-9)


def test_hexbin_counts_everything(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(size=(500, 2))],
                               "x double, y double")
    out = V.hexbin(df, "x", "y", bins=8).collect()
    assert sum(r["count"] for r in out) == 500
    assert len({(r.hex_i, r.hex_j) for r in out}) == len(out)


def test_group_stats_join_back_to_null_groups_too(spark):
    df = spark.createDataFrame([(None if k % 3 == 2 else k % 3, float(k)) for k in range(30)], "g int, v double")
    stats = df.groupBy("g").agg(F.avg("v").alias("m"))
    out = strategy.join_group_stats(df, stats, ["g"]).collect()
    assert len(out) == 30
    assert {r.g: r.m for r in out} == {0: 13.5, 1: 14.5, None: 15.5}


def test_rank_equals_order(spark):
    rows = [(f"c{i}", float((i * 7) % 11)) for i in range(40)]
    df = spark.createDataFrame(rows, "c string, m double")
    got = {r.c: r["rank"] for r in G.rank_categories(df, "m", tie_break=["c"]).collect()}
    assert got == {c: k + 1 for k, (c, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}


def test_salted_groups_equal_plain(spark):
    import pandas as pd
    from tabula.operators import udf as U
    df = spark.createDataFrame([(k % 2, float(k)) for k in range(200)], "g int, v double")

    def top(key, pdf):
        return pd.DataFrame({"g": [key[0]], "mx": [pdf["v"].max()]})

    plain = U.map_groups(df, ["g"], top, "g int, mx double", whole_group=True)
    salted = U.map_groups(df, ["g"], top, "g int, mx double", salt_buckets=8, combine={"mx": "max"})
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_grid_and_dims(spark):
    df = spark.createDataFrame([(0.0, 10.0), (4.0, 20.0)], "a double, b double")
    g = J.grid(df, {"ga": ("a", 3), "gb": ("b", 2)}).collect()
    assert len(g) == 6
    assert sorted({r.ga for r in g}) == [0.0, 2.0, 4.0]
    dims = C.table_dims(df).first()
    assert (dims.n_rows, dims.n_cols) == (2, 2)
    prof = C.column_profile(df).collect()
    assert [(r.position, r.column, r.non_null) for r in prof] == [(1, "a", 2), (2, "b", 2)]


def test_share_and_frequency(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    f = {r.k: (r["count"], r.percentage) for r in ST.frequency_table(df, "k").collect()}
    assert f == {"a": (2, 0.5), "b": (1, 0.25), "c": (1, 0.25)}


def test_cast_to_bad_type_is_null(spark):
    df = spark.createDataFrame([("12",), ("x",)], "s string")
    out = [r.s for r in C.cast_columns(df, {"s": "int"}).collect()]
    assert out == [12, None]


@pytest.mark.parametrize("method,kind", [("exact", "cont"), ("disc", "disc")])
def test_group_quantiles_match_numpy(spark, method, kind):
    rng = np.random.default_rng(11)
    vals = rng.normal(size=3000).round(2)
    grp = rng.integers(0, 2, size=3000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    out = ST.group_quantiles(df, "v", probs, ["g"], method=method).collect()
    assert len(out) == 2
    for r in out:
        sub = np.sort(vals[grp == r.g])
        if kind == "cont":
            want = np.percentile(sub, [p * 100 for p in probs])
        else:
            want = [sub[max(math.ceil(p * len(sub)) - 1, 0)] for p in probs]
        assert r["__n"] == len(sub)
        assert np.allclose(r["__qs"], want)


def test_binned_density_close_to_exact(spark):
    rng = np.random.default_rng(7)
    vals = rng.gamma(2.0, 3.0, size=4000)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(vals)], "v double, g int")
    exact = {(r.g, r["index"]): r.density for r in V.density_1d(df, "v", by=["g"], n=64, bins=None).collect()}
    binned = {(r.g, r["index"]): r.density for r in
              V.density_1d(df, "v", by=["g"], n=64, bins=2048).collect()}
    assert exact.keys() == binned.keys()
    peak = max(exact.values())
    assert max(abs(exact[k] - binned[k]) for k in exact) < 1e-3 * peak


def test_binned_density_2d_close_to_exact(spark):
    rng = np.random.default_rng(9)
    pts = rng.normal(size=(3000, 2)) * [1.0, 3.0]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "x double, y double")
    exact = {(r.i, r.j): r.density for r in V.density_2d(df, "x", "y", n=20, bins=None).collect()}
    binned = {(r.i, r.j): r.density for r in V.density_2d(df, "x", "y", n=20, bins=256).collect()}
    assert exact.keys() == binned.keys()
    peak = max(exact.values())
    assert max(abs(exact[k] - binned[k]) for k in exact) < 5e-3 * peak


@pytest.mark.parametrize("method", ["exact", "disc"])
def test_quantiles_of_nan_infinity_and_null(spark, method):
    """NaN sorts last, NULL is ignored, infinities stay; groups and columns in one plan."""
    nan, inf = float("nan"), float("inf")
    rows = [("a", 1.0, nan), ("a", 2.0, 5.0), ("a", nan, None), ("b", inf, 7.0), ("b", inf, 7.0),
            (None, None, 3.0), (None, -inf, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(3)
    got = {(r.g, r.column, r.prob): r.value
           for r in ST.quantiles(df, ["x", "y"], [0.0, 0.5, 1.0], by=["g"], method=method).collect()}
    assert got["a", "x", 0.0] == 1.0 and got["a", "x", 0.5] == 2.0 and math.isnan(got["a", "x", 1.0])
    assert got["a", "y", 0.0] == 5.0 and math.isnan(got["a", "y", 1.0])
    assert [got["b", "x", p] for p in (0.0, 0.5, 1.0)] == [inf] * 3
    assert got[None, "x", 0.5] == -inf
    assert got[None, "y", 0.5] == (3.5 if method == "exact" else 3.0)
    assert len(got) == 18


def test_quantiles_leave_nothing_cached(spark):
    df = spark.createDataFrame([(k % 3, float(k)) for k in range(100)], "g int, v double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    V.box_stats(df, "v", by=["g"]).collect()
    V.density_1d(df, "v", by=["g"], n=8).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("method", ["exact", "disc"])
def test_sorted_quantiles_match_numpy(spark, method):
    rng = np.random.default_rng(17)
    vals = rng.exponential(size=5000).round(4)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(7)
    probs = [0.0, 0.01, 0.33, 0.5, 0.999, 1.0]
    r = ST.group_quantiles(df, "v", probs, method=method).first()
    sv = np.sort(vals)
    if method == "exact":
        want = np.percentile(sv, [p * 100 for p in probs])
    else:
        want = [sv[max(math.ceil(p * len(sv)) - 1, 0)] for p in probs]
    assert r["__n"] == 5000
    assert np.allclose(r["__qs"], want)


def test_sorted_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(19)
    vals = np.concatenate([np.full(3000, 5.0), rng.normal(size=6000).round(5)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.1, 0.5, 0.66, 0.9]
    r = ST.group_quantiles(df, "v", probs).first()
    assert np.allclose(r["__qs"], np.percentile(vals, [p * 100 for p in probs]))


def test_set_operations_with_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,)] * 50 + [(3,)], "k int")
    assert sorted(r.k for r in S.except_rows(a, b).collect()) == [1]
    assert sorted(r.k for r in S.intersect_rows(a, b).collect()) == [2, 3]


def test_salted_join_equals_plain(spark):
    left = spark.createDataFrame([(k % 3, i) for i, k in enumerate([0] * 200 + list(range(50)))],
                                 "k int, i int")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k int, name string")
    plain = sorted(J.join_drop_key(left, right, "k").collect())
    salted = sorted(J.join_drop_key(left, right, "k", salt_buckets=8).collect())
    assert plain == salted and len(plain) == 250
    with pytest.raises(ValueError):
        J.join_drop_key(left, right, "k", how="right", salt_buckets=4)


def test_profile_preview(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, s string")
    prof = C.column_profile(df, preview=2).collect()
    assert [len(r.first_values) for r in prof] == [2, 2]
    assert prof[1].data_type == "string" and prof[1].non_null == 2


def test_rank_keeps_null_metric(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 1.0)], "c string, m double")
    got = {r.c: r["rank"] for r in G.rank_categories(df, "m").collect()}
    assert got == {"b": 1, "c": 2, "a": 3}


def test_crosstab_keeps_null_levels(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "p string, q string")
    out = {r["p_q"]: (r.x, r["null"]) for r in ST.crosstab(df, "p", "q", ["x", "null"]).collect()}
    assert out == {"a": (1, 1), None: (1, 0)}


def test_group_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(23)
    vals = np.concatenate([np.full(2500, 1.5), rng.normal(size=2500).round(4)])
    grp = np.zeros(len(vals), dtype=int)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    probs = [0.2, 0.5, 0.75, 0.95]
    r = ST.group_quantiles(df, "v", probs, ["g"]).first()
    assert np.allclose(r["__qs"], np.percentile(vals, [p * 100 for p in probs]))


def test_recipe_logistic_settings_on_cars(cars):
    # the recipe's settings (maxIter 10, regParam 0.3, elasticNet 0.8) fitted on
    # all 32 cars: the L1 part zeroes mpg and wt, disp and hp stay negative
    from pyspark.sql import functions as F
    from tabula.operators import models as M
    df = cars.withColumn("vs", F.col("vs").cast("int"))
    model = M.fit_logistic(df, "vs ~ mpg + disp + hp + wt")
    coef = {r.feature: r.estimate for r in M.coefficients(model, df).collect()}
    assert coef["mpg"] == 0.0 and coef["wt"] == 0.0
    assert coef["disp"] < 0 and coef["hp"] < 0
    assert coef["(Intercept)"] == pytest.approx(0.67916, abs=1e-4)
    assert coef["disp"] == pytest.approx(-0.00162, abs=1e-5)
    assert coef["hp"] == pytest.approx(-0.00389, abs=1e-5)


def test_cluster_conf_sizes_partitions():
    from tabula.session import cluster_conf
    conf = cluster_conf(100 * 1024**4, checkpoint_dir="hdfs:///shared/ckpt")
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 1024**4 // (256 * 1024**2))
    assert conf["spark.checkpoint.dir"] == "hdfs:///shared/ckpt"
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_inferred_udf_schema_keeps_types(spark):
    import pandas as pd
    from tabula.operators import udf as U
    df = spark.createDataFrame([(i, float(i), f"s{i}") for i in range(20)], "k int, x double, s string")
    out = U.map_partitions_inferred(df, lambda p: p.assign(y=p["x"] * 2, t=p["s"] + "!"))
    assert dict(out.dtypes) == {"k": "int", "x": "double", "s": "string", "y": "double", "t": "string"}
    assert out.count() == 20

    def per_group(key, pdf):
        return pd.DataFrame({"grp": [key[0]], "n": [len(pdf)]})

    grouped = df.withColumn("g", F.col("k") % 3)
    got = U.map_groups_inferred(grouped, ["g"], per_group, combine={"n": "sum"}, salt_buckets=4)
    assert {r.grp: r.n for r in got.collect()} == {0: 7, 1: 7, 2: 6}


def test_map_list_runs_every_item(spark):
    import pandas as pd
    from pyspark import TaskContext
    from tabula.operators import udf as U
    items = spark.range(5).withColumnRenamed("id", "item")

    def work(pdf):
        return pd.DataFrame({"item": pdf["item"], "task": TaskContext.get().partitionId()})

    out = U.map_list(items, ["item"], work, "item long, task int", tasks=64).collect()
    assert sorted(r.item for r in out) == [0, 1, 2, 3, 4]
    assert len({r.task for r in out}) > 1


def test_inferred_schemas_see_all_batches(spark):
    """A type that changes late in the table, and an empty table."""
    import pandas as pd
    from tabula.operators import udf as U
    df = spark.range(0, 3000, 1, 1)

    def late(pdf):
        return pd.DataFrame({"id": pdf["id"], "v": [int(k) if k < 2500 else k + 0.5 for k in pdf["id"]],
                             "w": [None if k < 2500 else "x" for k in pdf["id"]]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = U.map_partitions_inferred(df, late)
        assert dict(out.dtypes) == {"id": "bigint", "v": "double", "w": "string"}
        rows = {r.id: (r.v, r.w) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rows[7] == (7.0, None) and rows[2999] == (2999.5, "x")
    empty = U.map_partitions_inferred(df.limit(0), lambda pdf: pdf.assign(y=pdf["id"] * 0.5))
    assert empty.columns == ["id", "y"] and empty.collect() == []

    def count(key, pdf):
        return pd.DataFrame({"g": [key[0]], "n": [len(pdf)]})

    groups = df.selectExpr("id % 3 as g", "id")
    got = U.map_groups_inferred(groups, ["g"], count, combine={"n": "sum"}).collect()
    assert sorted((r.g, r.n) for r in got) == [(0, 1000), (1, 1000), (2, 1000)]
    with pytest.raises(ValueError):
        U.map_groups_inferred(groups, ["g"], count)
    none = U.map_groups_inferred(groups.limit(0), ["g"], count, combine={"n": "sum"}, schema="g long, n long")
    assert none.collect() == []


def test_confidence_band_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=60)
    y = 2 * x + rng.normal(size=60)
    rows = [(1, float(a), float(b)) for a, b in zip(x, y)] + [(2, 1.0, 2.0), (2, 1.0, 3.0), (1, None, 9.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    out = sorted((r for r in V.lm_band(df, "x", "y", ["g"], points=7, critical=2.0).collect() if r.g == 1),
                 key=lambda r: r["index"])
    b, a = np.polyfit(x, y, 1)
    s = math.sqrt(np.sum((y - a - b * x) ** 2) / 58)
    grid = np.linspace(x.min(), x.max(), 7)
    half = 2.0 * s * np.sqrt(1 / 60 + (grid - x.mean()) ** 2 / np.sum((x - x.mean()) ** 2))
    assert np.allclose([r.fit for r in out], a + b * grid)
    assert np.allclose([r.lower for r in out], a + b * grid - half)
    assert np.allclose([r.upper for r in out], a + b * grid + half)
    constant = V.lm_band(df.where("g = 2"), "x", "y", ["g"], points=3).collect()
    assert all(r.lower is None for r in constant)


def test_constant_columns_do_not_divide_by_zero(spark):
    # ANSI mode raises on a double division by zero; every operator must
    # handle a constant column without dividing by its zero range or spread
    const = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    assert V.hexbin(const, "x", "y", 10).first()["count"] == 5
    assert V.bin2d(const, "x", "y", 10).first()["count"] == 5
    assert V.density_2d(const, "x", "y", n=3).count() == 9
    assert V.density_2d(const, "x", "y", n=3, bins=4).count() == 9
    assert V.density_1d(const, "x", n=4, bins=8).count() == 4
    assert V.pair_matrix(const, ["x", "y"], []).count() == 22
    corr = {(r.var1, r.var2): r.value for r in ST.corr_matrix(const, ["x", "y"]).collect()}
    assert corr[("x", "y")] is None and corr[("x", "x")] is None
    assert ST.corr_pair(const, "x", "y").first()["corr"] is None


_STAT_CASES = {
    "hexbin": lambda d: V.hexbin(d, "x", "y", 10),
    "bin2d": lambda d: V.bin2d(d, "x", "y"),
    "density_1d": lambda d: V.density_1d(d, "x", by=["g"], n=4),
    "density_2d": lambda d: V.density_2d(d, "x", "y", n=3),
    "box": lambda d: V.box_stats(d, "x", by=["g"]),
    "pairs": lambda d: V.pair_matrix(d, ["x", "y"], ["g"]),
    "histogram": lambda d: ST.histogram(d, "x", 3, by=["g"]),
    "bivariate": lambda d: ST.bivariate_histogram(d, "x", "y", 5),
    "quantiles_sorted": lambda d: ST.quantiles(d, ["x"], [0.5]),
    "quantiles_bracket": lambda d: ST.quantiles(d, ["x"], [0.5], by=["g"]),
    "crosstab": lambda d: ST.crosstab(d, "g", "g", ["a", "other"]),
    "rank": lambda d: G.rank_categories(d, "x"),
    "profile": lambda d: C.column_profile(d, preview=2),
}


@pytest.mark.parametrize("name", sorted(_STAT_CASES))
def test_empty_and_null_inputs(spark, name):
    empty = spark.createDataFrame([], "g string, x double, y double")
    nulls = spark.createDataFrame([(None, None, None), ("a", None, 1.0)], "g string, x double, y double")
    for df in (empty, nulls):
        _STAT_CASES[name](df).collect()
