"""Hot keys, rank selection, Student's t, contours, dot density, mosaics, repeatable
samples, file order, safe replacement and label indices on small tables."""

import math
import os
import random
import statistics
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.functions.distributions import t_quantile
from tabula.operators import chartdata as V
from tabula.operators import groups as G
from tabula.operators import joins as J
from tabula.operators import models as M
from tabula.operators import stats as S
from tabula.operators import udf as U
from tabula.operators.hotkeys import copy_rows, hot_keys, split_rows
from tabula.operators.selection import select_ranks
from tabula.sources import files as IO


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# ---------------------------------------------------------------- hot keys

@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 has 5,000 equal rows, key 1 has 3,000 distinct ones, NULL 1,000, 500 keys have two."""
    rows = [(0, "same")] * 5000 + [(1, f"r{k}") for k in range(3000)] + [(None, f"n{k}") for k in range(1000)]
    rows += [(10 + k // 2, f"c{k}") for k in range(1000)]
    return spark.createDataFrame(rows, "k int, v string").repartition(5, "v")


def test_only_hot_keys_are_found(skewed):
    found = hot_keys(skewed, ["k"], parts=20)
    keys = skewed.select("k", F.xxhash64("k").alias("__hot")).distinct()
    parts = {r.k: r["__parts"] for r in found.join(keys, "__hot").collect()}
    assert parts == {0: 10, 1: 6, None: 2}


def test_parts_hold_all_rows_and_equal_rows_spread(skewed):
    hot = hot_keys(skewed, ["k"], parts=20)
    split = split_rows(skewed, ["k"], hot)
    assert rows_of(split, "k", "v") == rows_of(skewed)
    sizes = {(r.k, r["__part"]): r["count"] for r in split.groupBy("k", "__part").count().collect()}
    assert max(n for (k, _), n in sizes.items() if k == 0) <= 2048       # all alike, yet in parts
    assert sum(k == 1 for k, _ in sizes) == 6 and all(p == 0 for k, p in sizes if k is not None and k > 1)


def test_only_hot_keys_right_rows_are_copied(spark, skewed):
    right = spark.createDataFrame([(k, f"R{k}") for k in [0, 1, *range(10, 510)]] + [(None, "RN")], "k int, w string")
    hot = hot_keys(skewed, ["k"], parts=20)
    copies = {r.k: r["count"] for r in copy_rows(right, ["k"], hot).groupBy("k").count().collect()}
    assert copies[0] == 10 and copies[1] == 6 and copies[None] == 2
    assert all(n == 1 for k, n in copies.items() if k is not None and k > 1)
    for how in ("inner", "left"):
        assert rows_of(J.join_drop_key(skewed, right, "k", how, split_hot=True)) == rows_of(skewed.join(right, "k", how))


def test_groups_are_split_as_their_share_asks(skewed):
    calls = U.map_groups(skewed, ["k"], lambda key, pdf: pd.DataFrame({"k": [key[0]], "n": [len(pdf)], "calls": [1]}),
                         "k int, n long, calls long", {"n": "sum", "calls": "sum"}, salt_buckets=20)
    got = {None if r.k is None else r.k: (r.n, r.calls) for r in calls.collect()}
    assert got[1] == (3000, 6) and got[None] == (1000, 2) and got[10] == (2, 1) and got[0][0] == 5000
    assert 1 < got[0][1] <= 10


def test_no_rows_have_no_hot_keys(spark):
    none = spark.createDataFrame([], "k int, v string")
    assert hot_keys(none, ["k"]).count() == 0 and split_rows(none, ["k"], hot_keys(none, ["k"])).count() == 0


# ---------------------------------------------------------- rank selection

@pytest.mark.parametrize("kind", ["uniform", "spread", "ties", "two", "special"])
def test_all_ranks_of_awkward_values(spark, kind):
    rng = random.Random(kind)
    values = {"uniform": [rng.random() for _ in range(3000)],
              "spread": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(3000)],
              "ties": [float(rng.choice([1, 1, 1, 2, 3, 1e9])) for _ in range(3000)],
              "two": [0.0, 1.0],
              "special": [float("inf")] * 20 + [float("-inf")] * 5 + [float("nan")] * 30 + [0.0, -0.0, 5e-324]}[kind]
    n = len(values)
    df = spark.createDataFrame([(v,) for v in values], "__v double").repartition(4)
    wanted = sorted({0, 1, n // 7, n // 2, n - 2, n - 1})
    # far-off guesses and a short list cost passes, never the result
    row = select_ranks(df, [], [lambda _, r=r: F.lit(r) for r in wanted], [0.5] * len(wanted), listed=10).first()
    order = sorted(values, key=lambda v: (math.isnan(v), v))
    for j, r in enumerate(wanted):
        got, want = row[f"__s{j}"], order[r]
        assert got == want or (math.isnan(got) and math.isnan(want)), (r, got, want)


def test_quantiles_by_group_equal_numpy(spark):
    rng = np.random.default_rng(4)
    frames = [pd.DataFrame({"g": g, "v": rng.normal(size=n) ** 3}) for g, n in (("a", 20_000), ("b", 7), ("c", 1))]
    data = pd.concat([*frames, pd.DataFrame({"g": [None] * 50, "v": rng.integers(0, 3, 50).astype(float)})])
    df = spark.createDataFrame(data.astype({"g": object}), "g string, v double").repartition(6)
    probs = [0, 0.001, 0.25, 0.5, 0.9, 1]
    for r in S.group_quantiles(df, "v", probs, ["g"]).collect():
        own = data[data.g.isna() if r.g is None else data.g == r.g].v
        assert r["__n"] == len(own) and np.allclose(r["__qs"], np.quantile(own, probs), rtol=1e-12, atol=0)


def test_rank_selection_shuffles_no_rows(spark):
    df = spark.range(200_000).select((F.rand(1) * 1000).alias("__v"))
    plan = select_ranks(df, [], [lambda n: F.floor(n / 2)])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort [" not in plan


# -------------------------------------------------------------- Student's t

def test_t_quantile_equals_the_tables(spark):
    # fixed values: two-sided 95 % and 99 % points
    table = {1: (12.706204736432095, 63.656741162871), 2: (4.302652729911275, 9.924843200918), 3: (3.182446305284263, 5.840909309733),
             5: (2.570581835636314, 4.032142983557), 30: (2.042272456301238, 2.749995653567), 1000: (1.962339080826408, 2.580754697714)}
    df = spark.createDataFrame([(k,) for k in [*table, 0, None, 10**9]], "df bigint")
    for r in df.select("df", t_quantile(0.95, F.col("df")).alias("a"), t_quantile(0.99, F.col("df")).alias("b")).collect():
        if r.df in table:
            assert r.a == pytest.approx(table[r.df][0], rel=1e-9) and r.b == pytest.approx(table[r.df][1], rel=1e-9)
        elif r.df:
            assert r.a == pytest.approx(statistics.NormalDist().inv_cdf(0.975), rel=1e-8)
        else:
            assert r.a is None
    near = spark.createDataFrame([(1000,), (1001,)], "df bigint").select(t_quantile(0.9, F.col("df")).alias("t")).collect()
    assert 0 < near[0].t - near[1].t < 2e-6      # the two forms meet


def test_band_of_small_groups(spark):
    df = spark.createDataFrame([("a", float(x), y) for x, y in enumerate((1.0, 3.0, 2.0))] + [("b", 0.0, 1.0), ("b", 1.0, 2.0)],
                               "g string, x double, y double")
    got = {(r.g, r["index"]): r for r in V.lm_band(df, "x", "y", ["g"], points=3).collect()}
    # three points: fit 1.5 + x/2, residual sum of squares 1.5, one degree of freedom
    middle = got["a", 1]
    assert middle.fit == pytest.approx(2.0)
    assert middle.upper - middle.fit == pytest.approx(12.706204736432095 * math.sqrt(1.5 / 3), rel=1e-9)
    assert got["b", 0].lower is None


# ---------------------------------------------------------------- contours

def surface(spark, fn, n=21):
    return spark.createDataFrame([(i, j, i / (n - 1) * 2 - 1, j / (n - 1) * 2 - 1, fn(i / (n - 1) * 2 - 1, j / (n - 1) * 2 - 1))
                                  for i in range(n) for j in range(n)], "i int, j int, x double, y double, z double")


def test_contours_of_a_cone_are_circles(spark):
    got = V.contour_lines(surface(spark, lambda x, y: 1 - math.hypot(x, y), 41), [0.3, 0.55], "z").collect()
    for r in got:
        for x, y in ((r.x0, r.y0), (r.x1, r.y1)):
            assert math.hypot(x, y) == pytest.approx(1 - r.level, abs=0.01)
    for level in (0.3, 0.55):
        own = [r for r in got if r.level == level]
        ends = [tuple(np.round(p, 9)) for r in own for p in ((r.x0, r.y0), (r.x1, r.y1))]
        assert all(ends.count(p) % 2 == 0 for p in ends)            # closed
        length = sum(math.hypot(r.x1 - r.x0, r.y1 - r.y0) for r in own)
        assert length == pytest.approx(2 * math.pi * (1 - level), rel=0.01)


def test_saddles_cut_off_two_corners(spark):
    df = surface(spark, lambda x, y: x * y, 2)                       # 1 -1 -1 1, centre 0
    for level, edges in ((0.5, {(0, 3), (1, 2)}), (-0.5, {(0, 1), (2, 3)})):
        got = V.contour_lines(df, [level], "z").collect()
        assert {(r.edge0, r.edge1) for r in got} == edges


def test_all_cases_against_plain_crossings(spark):
    rng = random.Random(9)
    values = {(i, j): rng.choice([0.0, 1.0, 2.0, 3.0]) for i in range(30) for j in range(30)}
    df = spark.createDataFrame([(i, j, float(i), float(j), v) for (i, j), v in values.items()], "i int, j int, x double, y double, z double")
    got = {(r.i, r.j, r.edge0, r.edge1) for r in V.contour_lines(df, [1.5], "z").collect()}
    for i in range(29):
        for j in range(29):
            up = [values[p] >= 1.5 for p in ((i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1))]
            cut = [k for k in range(4) if up[k] != up[(k + 1) % 4]]
            own = sorted(k for a, b, *e in got if (a, b) == (i, j) for k in e)
            assert own == cut


def test_levels_are_round_and_flat_surfaces_have_none(spark):
    levels = {round(r.level, 9) for r in V.contour_lines(surface(spark, lambda x, y: 7 * x), 10, "z").collect()}
    assert levels == {float(k) for k in range(-6, 8)}
    assert V.contour_lines(surface(spark, lambda x, y: 3.0), 10, "z").count() == 0
    assert V.density_contours(spark.createDataFrame([], "a double, b double"), "a", "b").count() == 0


# ------------------------------------------------------------- dot density

def greedy(values, width):
    out = []
    for v in sorted(values):
        if not out or v >= out[-1][0] + width + 1e-8:
            out.append([v, v, 0])
        out[-1][1], out[-1][2] = v, out[-1][2] + 1
    return [(a, b, n) for a, b, n in out]


@pytest.mark.parametrize("width", [0.01, 0.7, 3.0, 40.0, 500.0])
@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_bins_cross_partition_borders(spark, width, parts):
    rng = random.Random(width)
    values = [round(rng.uniform(0, 100), 2) for _ in range(700)] + [50.0] * 300
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
        got = V.dotplot_density(df, "v", width).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.low, r.high, r["count"]) for r in got) == greedy(values, width)


def test_dot_density_by_groups(spark):
    rng = random.Random(2)
    groups = {"a": [rng.gauss(0, 5) for _ in range(400)], None: [rng.gauss(9, 1) for _ in range(60)], "c": [4.0]}
    df = spark.createDataFrame([(g, v) for g, own in groups.items() for v in own], "low string, v double").repartition(4)
    got = V.dotplot_density(df.withColumnRenamed("low", "g"), "v", 1.5, ["g"]).collect()
    for g, own in groups.items():
        assert sorted((r.low, r.high, r["count"]) for r in got if r.g == g) == greedy(own, 1.5)
    assert V.dotplot_density(df.where("v > 1e9"), "v").count() == 0


# ------------------------------------------------------------------ mosaic

def test_mosaic_fills_the_square(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "x"), ("b", None)], "p string, q string")
    got = V.mosaic_cells(df, "p", "q").collect()
    assert sum((r.x1 - r.x0) * (r.y1 - r.y0) for r in got) == pytest.approx(1)
    cell = next(r for r in got if (r.p, r.q) == ("a", "x"))
    assert (cell.x0, cell.x1, cell.y0, cell.y1) == pytest.approx((0.2, 0.8, 0, 2 / 3))


# ----------------------------------------------------------------- samples

def test_samples_do_not_depend_on_the_layout(spark):
    rows = [(k, f"t{k % 7}") for k in range(2000)]
    one = spark.createDataFrame(rows, "id int, t string").coalesce(1)
    other = spark.createDataFrame(rows[::-1], "id int, t string").repartition(13, "t")
    for key in (["id"], None):
        a, b = (rows_of(S.sample_exact(df, rows=333, seed=5, key=key)) for df in (one, other))
        assert a == b and len(a) == 333 and a != rows_of(S.sample_exact(one, rows=333, seed=6, key=key))
        parts, again = ([rows_of(p) for p in S.split_exact(df, [3, 1, 0], 5, key)] for df in (one, other))
        assert parts == again and sorted(sum(parts, [])) == sorted(rows) and parts[2] == []
        assert abs(len(parts[0]) - 1500) < 100


def test_equal_rows_are_drawn_one_by_one(spark):
    df = spark.createDataFrame([("x",)] * 3000 + [(None,)] * 1000, "a string").repartition(4)
    assert {r.a: r["count"] for r in S.sample_exact(df, rows=4000).groupBy("a").count().collect()} == {"x": 3000, None: 1000}
    drawn = {r.a: r["count"] for r in S.sample_exact(df, 0.25, seed=1).groupBy("a").count().collect()}
    assert sum(drawn.values()) == 1000 and 600 < drawn["x"] < 900
    train, test = S.split_exact(df, [0.5, 0.5])
    assert train.count() + test.count() == 4000 and 1800 < train.count() < 2200


def test_sample_sizes_at_the_ends(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    assert S.sample_exact(df, rows=0).count() == 0 and S.sample_exact(df, rows=99).count() == 10
    assert S.sample_exact(df.where("k > 99"), 0.5).count() == 0
    with pytest.raises(ValueError):
        S.sample_exact(df)


# --------------------------------------------------- file order, replacing

def test_head_is_in_file_order(spark):
    path = tempfile.mkdtemp(prefix="tabula-head-")
    spark.createDataFrame([(9 - k, k) for k in range(10)], "a int, k int").coalesce(1).write.mode("overwrite").parquet(path)
    df = G.head(spark.read.parquet(path), 4)
    assert [tuple(r) for r in df.collect()] == [(9, 0), (8, 1), (7, 2), (6, 3)]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert G.head(spark.read.parquet(path), 0).count() == 0 and G.head(spark.read.parquet(path), 99).count() == 10


def test_a_failed_write_leaves_the_old_table(spark):
    folder = tempfile.mkdtemp(prefix="tabula-replace-")
    path = f"{folder}/t"
    IO.replace_table(spark.range(5), path)
    bad = spark.read.parquet(path).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        IO.replace_table(bad, path)
    assert rows_of(spark.read.parquet(path)) == [(k,) for k in range(5)] and os.listdir(folder) == ["t"]
    IO.replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert rows_of(spark.read.parquet(path)) == [(3,), (4,)] and os.listdir(folder) == ["t"]


# ------------------------------------------------------------------ labels

def test_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",)] * 3 + [("a",)] * 3 + [("c",)] * 5 + [(None,)], "t string").repartition(3)
    indexed, labels = M.index_labels(df, "t")
    assert sorted((r.t, r["count"], r.label_index) for r in labels.collect()) == [("a", 3, 1.0), ("b", 3, 2.0), ("c", 5, 0.0)]
    assert {r.t: r.label_index for r in indexed.collect()} == {"a": 1.0, "b": 2.0, "c": 0.0, None: None}
    assert indexed.count() == 12


# ------------------------------------------------------- pairs plot by grouping sets

def test_pair_matrix_counts_null_levels_and_empty_bins(spark):
    rows = [(1.0, "a", None), (1.0, "a", "u"), (None, None, "u"), (5.0, None, None), (4.0, "b", "u")]
    df = spark.createDataFrame(rows, "x double, g string, h string")
    found = {(r.var1, r.var2, r.level1, r.level2): r.value
             for r in V.pair_matrix(df, ["x"], ["g", "h"], nbins=4).collect() if r.kind in ("hist", "count")}
    assert found == {
        ("x", "x", "0", None): 2, ("x", "x", "1", None): 0, ("x", "x", "2", None): 1, ("x", "x", "3", None): 1,
        ("g", "g", "a", None): 2, ("g", "g", "b", None): 1, ("g", "g", None, None): 2,
        ("h", "h", "u", None): 3, ("h", "h", None, None): 2,
        ("g", "h", "a", None): 1, ("g", "h", "a", "u"): 1, ("g", "h", "b", "u"): 1,
        ("g", "h", None, "u"): 1, ("g", "h", None, None): 1}


def test_pair_matrix_of_a_column_in_both_roles(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    found = sorted((r.kind, r.level1, r.value) for r in V.pair_matrix(df, ["x"], ["x"], nbins=2).collect()
                   if r.kind in ("hist", "count"))
    assert found == [("count", "1", 1.0), ("count", "2", 2.0), ("hist", "0", 1.0), ("hist", "1", 2.0)]


def test_pair_matrix_counts_by_grouping_sets(spark):
    df = spark.createDataFrame([(1.0, "a", "u")], "x double, g string, h string")
    plan = V._panel_counts(df, ["x"], ["g", "h"], 4, df.agg(F.min("x").alias("__mn0"), F.max("x").alias("__mx0"))
                           )._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan
