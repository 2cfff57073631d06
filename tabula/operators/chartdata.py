"""The statistic behind each chart, as a distributed aggregation (VIZ1-VIZ19).

Drawing is the caller's business; every function here returns a small table
(one row per bar, bin, grid point or group) computed where the data lives.

Scale notes
-----------
* Counts, means, regression sums and bins are mergeable aggregates: Spark
  pre-aggregates them map-side, so a group holding a third of all rows costs
  one partial row per task, never a whole group in one task.
* Per-group statistics that must be fed back to the rows (box-plot fences,
  density grids, histogram ranges) are joined through
  :func:`tabula.plans.strategy.join_group_stats`, a plain equality join that
  adaptive execution turns into a broadcast or splits at hot groups.
* Kernel densities spread the values linearly over equally spaced bins first,
  so the work is bins × grid points whatever the number of rows; the grid is
  generated with ``sequence`` + ``explode`` and consumed by the partial
  aggregate in the same stage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.distributions import t_quantile
from tabula.functions.scalar import range_bucket, range_bucket_order
from tabula.operators.stats import DEFAULT_ACCURACY, group_quantiles, safe_corr
from tabula.plans.strategy import attach_scalars, cut_lineage, join_group_stats

SQRT_2PI = math.sqrt(2.0 * math.pi)


def _num(col: str) -> Column:
    return F.col(col).cast("double")


def _stats_of(vals: DataFrame, by: list[str], aggs: list[Column]) -> DataFrame:
    return vals.groupBy(*by).agg(*aggs) if by else vals.agg(*aggs)


# --------------------------------------------------------------------------
# counts and shares (VIZ1-VIZ3, VIZ9, VIZ10)
# --------------------------------------------------------------------------


def bar_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VIZ1: bar heights — rows per combination of 1-3 categories (axis, fill, facets)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def bar_share(df: DataFrame, x: str, fill: str, facets: Sequence[str] = ()) -> DataFrame:
    """VIZ2: proportions of ``fill`` within each ``x`` (100 % bars, spine, mosaic).

    ``(facets..., x, fill, count, share)``; the per-``x`` totals are one row per
    bar.
    """
    keys = [*facets, x]
    counts = df.groupBy(*keys, fill).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(*keys).agg(F.sum("count").alias("__total"))
    out = join_group_stats(counts, totals, keys)
    return out.withColumn("share", F.col("count") / F.col("__total")).drop("__total")


def mosaic_cells(df: DataFrame, x: str, fill: str, facets: Sequence[str] = ()) -> DataFrame:
    """VIZ2: the rectangles of a spine or mosaic plot.

    ``(facets..., x, fill, count, x0, x1, y0, y1)``: a category of ``x`` is as
    wide as its share of the facet's rows, a cell of it as high as its share of
    that category; both axes run from 0 to 1, categories in ascending order.
    The running shares are windows over the counts, one row per cell.
    """
    facets = list(facets)
    counts = df.groupBy(*facets, x, fill).agg(F.count(F.lit(1)).alias("count"))
    whole = Window.partitionBy(*facets, x)
    upto = whole.orderBy(fill).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = counts.select(*facets, x, fill, "count", F.sum("count").over(whole).alias("__own"),
                          F.sum("count").over(upto).alias("__upto"))
    bars = counts.groupBy(*facets, x).agg(F.sum("count").alias("__width"))
    facet = Window.partitionBy(*facets) if facets else Window.partitionBy(F.lit(0))
    along = facet.orderBy(x).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bars = bars.select(*facets, x, F.sum("__width").over(along).alias("__right"),
                       F.sum("__width").over(facet).alias("__total"))
    placed = join_group_stats(cells, bars, [*facets, x])
    return placed.select(*facets, x, fill, "count",
                         ((F.col("__right") - F.col("__own")) / F.col("__total")).alias("x0"),
                         (F.col("__right") / F.col("__total")).alias("x1"),
                         ((F.col("__upto") - F.col("count")) / F.col("__own")).alias("y0"),
                         (F.col("__upto") / F.col("__own")).alias("y1"))


def dotplot_bins(df: DataFrame, col: str, binwidth: float = 1.0,
                 by: Sequence[str] = ()) -> DataFrame:
    """VIZ3: dot-plot stacks — counts per bin of width ``binwidth`` (``[k·w, (k+1)·w)``)."""
    b = F.floor(_num(col) / F.lit(binwidth))
    return (df.where(F.col(col).isNotNull())
              .groupBy(*by, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count"))
              .withColumn("center", (F.col("bin") + F.lit(0.5)) * F.lit(binwidth)))


#: A value this close to a bin's end still belongs to the bin, as in the usual dot plots.
DOT_SLACK = 1e-8


def dotplot_density(df: DataFrame, col: str, binwidth: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """VIZ3: dot-density bins, which start at data points.

    The first bin of a group starts at its smallest value; each next one at the
    first value that lies ``binwidth`` or more beyond the start of the one
    before.  Output ``(by..., low, high, count, center)``: the bin's smallest
    and largest value, its rows, and the middle of the two (where the stack of
    dots stands).  NULL and NaN values are left out.

    Where a bin starts depends on all bins before it, yet the values never meet
    in one task.  They are counted and range partitioned; every partition says
    where it is left if it is entered at one of the values that may start its
    first bin (those within a bin's width of its smallest).  A walk over these
    few rows, in order and with one number as its state, gives each partition
    its entry, and all partitions then cut their own bins at once; a bin that
    spans a border comes out in two parts, which the last aggregate joins.
    """
    by = list(by)
    if not binwidth > 0:
        raise ValueError("binwidth must be positive")
    step = float(binwidth) + DOT_SLACK
    keys = [f"__k{i}" for i in range(len(by))]
    vals = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], _num(col).alias("__v"))
    counted = (vals.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
               .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c")))
    dealt = cut_lineage(counted.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id()))
    types = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    names = [*keys, "__part"]

    def schema(*own: str) -> str:
        return ", ".join([*(f"`{k}` {types[k]}" for k in names), *own])

    def entries(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["__v"].to_numpy())
        after = np.searchsorted(values, values + step, "left")     # where the next bin starts
        after = np.maximum(after, np.arange(len(values)) + 1)      # a step too small for the value's size
        left = np.arange(len(values))
        for i in range(len(values) - 1, -1, -1):
            if after[i] < len(values):
                left[i] = left[after[i]]
        n = min(int(after[0]) + 1, len(values))                     # the last bin before may reach so far
        out = pd.DataFrame({"__v": values[:n], "__left": values[left[:n]]})
        return _with_keys(out, names, key)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = part = start = None
        passed = False
        for batch in batches:
            out = []
            for *own, number, value, left in zip(*(c.to_pylist() for c in batch.columns)):
                if own != group:
                    group, part, start = own, None, None
                if number != part:
                    part, passed = number, False
                if not passed and (start is None or value >= start + step):
                    out.append((*own, number, value))
                    start, passed = left, True
            if out:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out), batch.schema)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "__first"])

    def bins(key: tuple, pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__v")
        values, counts = pdf["__v"].to_numpy(), pdf["__c"].to_numpy()
        at = int(np.searchsorted(values, entry["__first"].iloc[0])) if len(entry) else len(values)
        starts = [0] if at else []                                  # the rest of the bin before
        while at < len(values):
            starts.append(at)
            at = max(int(np.searchsorted(values, values[at] + step, "left")), at + 1)
        ends = np.array([*starts[1:], len(values)]) - 1
        first = int(np.searchsorted(values, entry["__first"].iloc[0])) if len(entry) else len(values)
        out = pd.DataFrame({
            "__start": [None if s < first else values[s] for s in starts], "__low": values[starts],
            "__high": values[ends], "__n": np.add.reduceat(counts, starts)})
        out["__start"] = out["__start"].astype("float64")
        return _with_keys(out, names, key)

    found = dealt.groupBy(*names).applyInPandas(entries, schema("__v double", "__left double"))
    ordered = (found.repartition(*keys) if keys else found.repartition(1)).sortWithinPartitions(*names, "__v")
    firsts = cut_lineage(ordered.select(*names, "__v", "__left").mapInArrow(walk, schema("__first double")))
    pieces = cut_lineage(dealt.groupBy(*names).cogroup(firsts.groupBy(*names)).applyInPandas(
        bins, schema("__start double", "__low double", "__high double", "__n bigint")))
    # a rest belongs to the last bin that starts in an earlier partition of its group
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    last = (pieces.groupBy(*names).agg(F.max("__start").alias("__last"))
            .select(*names, F.last("__last", ignorenulls=True).over(before).alias("__carried")))
    joined = join_group_stats(pieces, last, names)
    start = F.coalesce("__start", "__carried")
    return (joined.groupBy(*keys, start.alias("__start"))
            .agg(F.min("__low").alias("low"), F.max("__high").alias("high"), F.sum("__n").alias("count"))
            .select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "low", "high", "count",
                    ((F.col("low") + F.col("high")) / 2).alias("center")))


def _with_keys(out: pd.DataFrame, names: list[str], key: tuple) -> pd.DataFrame:
    """``out`` behind constant columns that hold a group's key."""
    for name, value in zip(reversed(names), reversed(key)):
        out.insert(0, name, pd.Series([value] * len(out), dtype=object if value is None else None))
    return out


def bin2d(df: DataFrame, x: str, y: str, bins: int = 30) -> DataFrame:
    """VIZ9: rectangular 2-D bin counts over the data range, ``bins`` per axis.

    Bin ``i`` covers ``[min + i·w, min + (i+1)·w)``; the maximum goes to the last
    bin.  Output ``(x_bin, y_bin, x_center, y_center, count)``.
    """
    stats = df.agg(F.min(_num(x)).alias("__xmn"), F.max(_num(x)).alias("__xmx"),
                   F.min(_num(y)).alias("__ymn"), F.max(_num(y)).alias("__ymx"))
    vals = df.select(_num(x).alias("__x"), _num(y).alias("__y")) \
        .where(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    withs = attach_scalars(vals, stats)

    def idx(v, mn, mx):
        w = (F.col(mx) - F.col(mn)) / F.lit(bins)
        raw = F.floor((F.col(v) - F.col(mn)) / w)
        return F.when(w == 0, F.lit(0).cast("long")).otherwise(F.least(raw, F.lit(bins - 1)))

    binned = withs.select(idx("__x", "__xmn", "__xmx").alias("x_bin"),
                          idx("__y", "__ymn", "__ymx").alias("y_bin"),
                          "__xmn", "__xmx", "__ymn", "__ymx")
    out = binned.groupBy("x_bin", "y_bin", "__xmn", "__xmx", "__ymn", "__ymx").agg(
        F.count(F.lit(1)).alias("count"))
    wx = (F.col("__xmx") - F.col("__xmn")) / F.lit(bins)
    wy = (F.col("__ymx") - F.col("__ymn")) / F.lit(bins)
    return out.select("x_bin", "y_bin",
                      (F.col("__xmn") + (F.col("x_bin") + 0.5) * wx).alias("x_center"),
                      (F.col("__ymn") + (F.col("y_bin") + 0.5) * wy).alias("y_center"),
                      "count")


def hexbin(df: DataFrame, x: str, y: str, bins: int = 30,
           where: Column | str | None = None) -> DataFrame:
    """VIZ10: hexagon bin counts (Carr et al. 1987 rounding).

    Cell width ``dx = (max-min)/bins`` on x, ``dy = (max-min)/bins`` on y,
    taken over the *whole* table so that a filtered subset (``where``) uses the
    same lattice.  With ``sx = (x-xmin)/dx`` and ``sy = (y-ymin)/(dy·√3)`` the
    two candidate centres are ``(round(sx), round(sy))`` and
    ``(floor(sx)+.5, floor(sy)+.5)``; the nearer one in the metric
    ``(sx-i)² + 3(sy-j)²`` wins (ties → the first).  Output
    ``(hex_i, hex_j, x_center, y_center, count)``.
    """
    sqrt3 = math.sqrt(3.0)
    stats = df.agg(F.min(_num(x)).alias("__xmn"), F.max(_num(x)).alias("__xmx"),
                   F.min(_num(y)).alias("__ymn"), F.max(_num(y)).alias("__ymx"))
    rows = df if where is None else df.where(where)
    vals = rows.select(_num(x).alias("__x"), _num(y).alias("__y")) \
        .where(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    withs = attach_scalars(vals, stats)
    # a constant axis gets unit cells (one column / row of hexagons)
    dx = F.when(F.col("__xmx") > F.col("__xmn"),
                (F.col("__xmx") - F.col("__xmn")) / F.lit(bins)).otherwise(F.lit(1.0))
    dy = F.when(F.col("__ymx") > F.col("__ymn"),
                (F.col("__ymx") - F.col("__ymn")) / F.lit(bins)).otherwise(F.lit(1.0))
    sx = (F.col("__x") - F.col("__xmn")) / dx
    sy = (F.col("__y") - F.col("__ymn")) / (dy * F.lit(sqrt3))
    t = withs.select("__xmn", "__ymn", dx.alias("__dx"), dy.alias("__dy"),
                     sx.alias("sx"), sy.alias("sy"))
    i1, j1 = F.floor(F.col("sx") + 0.5).cast("double"), F.floor(F.col("sy") + 0.5).cast("double")
    i2, j2 = F.floor("sx").cast("double") + 0.5, F.floor("sy").cast("double") + 0.5
    ex1, ey1 = F.col("sx") - i1, F.col("sy") - j1
    ex2, ey2 = F.col("sx") - i2, F.col("sy") - j2
    d1 = ex1 * ex1 + F.lit(3.0) * (ey1 * ey1)
    d2 = ex2 * ex2 + F.lit(3.0) * (ey2 * ey2)
    first = d1 <= d2
    cells = t.select(F.when(first, i1).otherwise(i2).alias("hex_i"),
                     F.when(first, j1).otherwise(j2).alias("hex_j"),
                     "__xmn", "__ymn", "__dx", "__dy")
    out = cells.groupBy("hex_i", "hex_j", "__xmn", "__ymn", "__dx", "__dy").agg(
        F.count(F.lit(1)).alias("count"))
    return out.select("hex_i", "hex_j",
                      (F.col("__xmn") + F.col("hex_i") * F.col("__dx")).alias("x_center"),
                      (F.col("__ymn") + F.col("hex_j") * F.col("__dy") * F.lit(sqrt3)).alias("y_center"),
                      "count")


# --------------------------------------------------------------------------
# box plots (VIZ4, VIZ5)
# --------------------------------------------------------------------------


def _box_quartiles(df: DataFrame, value: str, by: list[str], method: str,
                   accuracy: int, coef: float) -> tuple[DataFrame, DataFrame]:
    vals = df.select(*by, _num(value).alias("__v")).where(F.col("__v").isNotNull())
    q = group_quantiles(vals, "__v", [0.25, 0.5, 0.75], by, method, accuracy)
    iqr = F.col("__qs")[2] - F.col("__qs")[0]
    q = q.select(*by, F.col("__n").alias("n"), F.col("__qs")[0].alias("q1"),
                 F.col("__qs")[1].alias("median"), F.col("__qs")[2].alias("q3"), iqr.alias("iqr"),
                 (F.col("__qs")[0] - F.lit(coef) * iqr).alias("lower_fence"),
                 (F.col("__qs")[2] + F.lit(coef) * iqr).alias("upper_fence"))
    return vals, q


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), coef: float = 1.5,
              notch: bool = False, method: str = "exact", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """VIZ4/VIZ5: box-plot statistics per group.

    ``(by..., n, q1, median, q3, iqr, lower_fence, upper_fence, whisker_low,
    whisker_high, n_outliers[, notch_low, notch_high])``.  Quartiles are R
    type 7 (``method="exact"``) or sketch-based (``"approx"``);
    whiskers are the most extreme values inside ``coef·IQR`` of the box; the
    notch is ``median ± 1.58·IQR/√n``.

    Two passes: quartiles (mergeable per group), then fences joined back to the
    rows for whiskers and outlier counts (mergeable again).
    """
    by = list(by)
    vals, q = _box_quartiles(df, value, by, method, accuracy, coef)
    q = cut_lineage(q)      # used for the fences and again for the result
    withq = join_group_stats(vals, q.select(*by, "lower_fence", "upper_fence"), by)
    v, lf, uf = F.col("__v"), F.col("lower_fence"), F.col("upper_fence")
    w = _stats_of(withq, by, [
        F.min(F.when(v >= lf, v)).alias("whisker_low"),
        F.max(F.when(v <= uf, v)).alias("whisker_high"),
        F.count_if((v < lf) | (v > uf)).alias("n_outliers")])
    if by:
        out = join_group_stats(q, w, by)
    else:
        out = attach_scalars(q, w)
    if notch:
        half = F.lit(1.58) * F.col("iqr") / F.sqrt(F.col("n").cast("double"))
        out = out.withColumn("notch_low", F.col("median") - half) \
                 .withColumn("notch_high", F.col("median") + half)
    return out


def box_outliers(df: DataFrame, value: str, by: Sequence[str] = (), keep: Sequence[str] = (),
                 coef: float = 1.5, method: str = "exact", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """VIZ4: the outlier points of each box — rows outside ``coef·IQR``.

    ``(by..., keep..., value)``; the rows stay distributed.
    """
    by = list(by)
    rows = df.select(*by, *keep, _num(value).alias("__v")).where(F.col("__v").isNotNull())
    _, q = _box_quartiles(df, value, by, method, accuracy, coef)
    withq = join_group_stats(rows, q.select(*by, "lower_fence", "upper_fence"), by)
    v = F.col("__v")
    return withq.where((v < F.col("lower_fence")) | (v > F.col("upper_fence"))) \
        .select(*by, *keep, v.alias(value))


# --------------------------------------------------------------------------
# kernel densities (VIZ6-VIZ8)
# --------------------------------------------------------------------------


def _nrd0(sd: Column, iqr: Column, n: Column, mn: Column) -> Column:
    """Silverman's rule ``0.9·min(sd, IQR/1.34)·n^(-1/5)`` with R's fallbacks."""
    lo = F.least(sd, iqr / F.lit(1.34))
    lo = F.when(lo > 0, lo).when(sd > 0, sd).when(F.abs(mn) > 0, F.abs(mn)).otherwise(F.lit(1.0))
    return F.lit(0.9) * lo * F.pow(n.cast("double"), F.lit(-0.2))


def _nrd(sd: Column, iqr: Column, n: Column, mn: Column) -> Column:
    """``bandwidth.nrd``: ``4·1.06·min(sd, IQR/1.34)·n^(-1/5)``; when that is 0
    (a constant axis) the same fallbacks as Silverman's rule keep it positive."""
    lo = F.least(sd, iqr / F.lit(1.34))
    lo = F.when(lo > 0, lo).when(sd > 0, sd).when(F.abs(mn) > 0, F.abs(mn)).otherwise(F.lit(1.0))
    return F.lit(4 * 1.06) * lo * F.pow(n.cast("double"), F.lit(-0.2))


def density_1d(df: DataFrame, col: str, by: Sequence[str] = (), n: int = 512,
               bw: float | None = None, method: str = "exact",
               accuracy: int = DEFAULT_ACCURACY, bins: int | None = 512) -> DataFrame:
    """VIZ6/VIZ7: Gaussian kernel density on ``n`` evenly spaced points from min to max.

    ``f(g) = 1/(N·h·√(2π)) · Σ exp(-(g - x)²/(2h²))``; ``h`` defaults to
    Silverman's rule per group.  With ``by`` this is the violin statistic.
    Output ``(by..., index, x, density, bandwidth)``.

    Every value's weight is split linearly between the two nearest of ``bins``
    equally spaced points (linear binning, as R's ``density`` does), which
    bounds the work to groups × ``bins`` × ``n`` at an error of order
    ``(range/bins)²/h²``.  With ``bins=None`` the sum runs over the distinct
    values instead: distinct values × ``n``, only for small tables.
    """
    by = list(by)
    if n < 2:
        raise ValueError("n must be at least 2")
    vals = df.select(*by, _num(col).alias("__v")).where(F.col("__v").isNotNull())
    ends = {"__mn": F.min("__v"), "__mx": F.max("__v")}
    if bw is None:
        # range, spread and the quartiles' first guesses come from one pass
        stats = group_quantiles(vals, "__v", [0.25, 0.75], by, method, accuracy,
                                {**ends, "__sd": F.stddev_samp("__v")})
        iqr = F.col("__qs")[1] - F.col("__qs")[0]
        stats = cut_lineage(stats.withColumn("__bw", _nrd0(F.col("__sd"), iqr, F.col("__n"), F.col("__mn"))))
    else:
        stats = _stats_of(vals, by, [F.count(F.lit(1)).alias("__n"), *[c.alias(k) for k, c in ends.items()]])
        stats = stats.withColumn("__bw", F.lit(float(bw)))
    stats = stats.select(*by, "__n", "__mn", "__mx", "__bw")
    if bins is None:
        weights = vals.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__w"))
    else:
        weights = _linear_bins(vals, stats.select(*by, "__mn", "__mx"), by, bins)
    withs = join_group_stats(weights, stats, by)
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("index")
    grid = withs.select(*by, "__v", "__w", "__n", "__mn", "__mx", "__bw", k)
    gx = F.col("__mn") + F.col("index") * (F.col("__mx") - F.col("__mn")) / F.lit(n - 1)
    u = (gx - F.col("__v")) / F.col("__bw")
    contrib = F.col("__w") * F.exp(F.lit(-0.5) * u * u)
    summed = grid.groupBy(*by, "index", "__n", "__mn", "__mx", "__bw").agg(F.sum(contrib).alias("__s"))
    return summed.select(
        *by, "index", gx.alias("x"),
        (F.col("__s") / (F.col("__n") * F.col("__bw") * F.lit(SQRT_2PI))).alias("density"),
        F.col("__bw").alias("bandwidth"))


def _linear_bins(vals: DataFrame, ranges: DataFrame, by: list[str], bins: int) -> DataFrame:
    """Weights of ``bins`` equally spaced points per group, each value's unit
    weight split between its two neighbours: ``(by..., __v, __w)``."""
    if bins < 2:
        raise ValueError("bins must be at least 2")
    withr = join_group_stats(vals, ranges, by)
    span = F.col("__mx") - F.col("__mn")
    g = F.when(span > 0, (F.col("__v") - F.col("__mn")) / span * F.lit(bins - 1)).otherwise(F.lit(0.0))
    lo = F.least(F.floor(g), F.lit(bins - 2))
    frac = g - lo
    parts = withr.select(*by, "__mn", "__mx", F.explode(F.array(
        F.struct(lo.alias("__i"), (F.lit(1.0) - frac).alias("__w")),
        F.struct((lo + 1).alias("__i"), frac.alias("__w")))).alias("__e"))
    summed = parts.groupBy(*by, "__mn", "__mx", F.col("__e.__i").alias("__i")) \
        .agg(F.sum("__e.__w").alias("__w"))
    point = F.col("__mn") + F.col("__i") * (F.col("__mx") - F.col("__mn")) / F.lit(bins - 1)
    return summed.where(F.col("__w") > 0).select(*by, point.alias("__v"), "__w")


def _bilinear_bins(vals: DataFrame, stats: DataFrame, bins: int) -> DataFrame:
    """``(__x, __y, __w)`` on a ``bins × bins`` lattice over the data range, each
    point's unit weight split among the four surrounding lattice points."""
    if bins < 2:
        raise ValueError("bins must be at least 2")
    withs = attach_scalars(vals, stats.select("__xmn", "__xmx", "__ymn", "__ymx"))

    def axis(v: str, mn: str, mx: str) -> tuple[Column, Column]:
        span = F.col(mx) - F.col(mn)
        g = F.when(span > 0, (F.col(v) - F.col(mn)) / span * F.lit(bins - 1)).otherwise(F.lit(0.0))
        lo = F.least(F.floor(g), F.lit(bins - 2))
        return lo, g - lo

    xi, xf = axis("__x", "__xmn", "__xmx")
    yi, yf = axis("__y", "__ymn", "__ymx")
    t = withs.select("__xmn", "__xmx", "__ymn", "__ymx", xi.alias("__xi"), xf.alias("__xf"),
                     yi.alias("__yi"), yf.alias("__yf"))
    one = F.lit(1.0)
    corners = F.array(*[
        F.struct((F.col("__xi") + dx).alias("__i"), (F.col("__yi") + dy).alias("__j"),
                 ((F.col("__xf") if dx else one - F.col("__xf")) *
                  (F.col("__yf") if dy else one - F.col("__yf"))).alias("__w"))
        for dx in (0, 1) for dy in (0, 1)])
    summed = t.select("__xmn", "__xmx", "__ymn", "__ymx", F.explode(corners).alias("__e")) \
        .groupBy("__xmn", "__xmx", "__ymn", "__ymx", F.col("__e.__i").alias("__i"),
                 F.col("__e.__j").alias("__j")).agg(F.sum("__e.__w").alias("__w"))
    step = lambda lo, hi: (F.col(hi) - F.col(lo)) / F.lit(bins - 1)
    return summed.where(F.col("__w") > 0).select(
        (F.col("__xmn") + F.col("__i") * step("__xmn", "__xmx")).alias("__x"),
        (F.col("__ymn") + F.col("__j") * step("__ymn", "__ymx")).alias("__y"), "__w")


def density_2d(df: DataFrame, x: str, y: str, n: int = 50,
               h: tuple[float, float] | None = None, method: str = "exact",
               accuracy: int = DEFAULT_ACCURACY, bins: int | None = 128) -> DataFrame:
    """VIZ8: bivariate Gaussian kernel density on an ``n × n`` grid (``kde2d``).

    Bandwidths default to ``bandwidth.nrd`` per axis and are divided by 4 as in
    ``kde2d``.  Output ``(i, j, x, y, density)``.

    Work is split by axis: for each distinct ``x`` value the y-kernels of its
    rows are summed first (rows × n), then combined with the x-kernel
    (distinct x × n × n) — the n² grid never multiplies the row count.  The
    points are first spread bilinearly onto a ``bins × bins`` lattice, which
    bounds both steps; ``bins=None`` uses every distinct point instead.
    """
    vx, vy = _num(x), _num(y)
    vals = df.select(vx.alias("__x"), vy.alias("__y")) \
        .where(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    if h is None:
        # both axes in one plan, keyed by axis: range, spread and quartiles
        axes = vals.select(F.explode(F.array(
            F.struct(F.lit("x").alias("__axis"), F.col("__x").alias("__a")),
            F.struct(F.lit("y").alias("__axis"), F.col("__y").alias("__a")))).alias("__e")) \
            .select("__e.*")
        own = group_quantiles(axes, "__a", [0.25, 0.75], ["__axis"], method, accuracy,
                              {"__mn": F.min("__v"), "__mx": F.max("__v"), "__sd": F.stddev_samp("__v")})
        iqr = F.col("__qs")[1] - F.col("__qs")[0]
        own = own.withColumn("__h", _nrd(F.col("__sd"), iqr, F.col("__n"), F.col("__mn")) / 4)

        def of(axis: str, name: str, alias: str) -> Column:
            return F.max(F.when(F.col("__axis") == axis, F.col(name))).alias(alias)

        stats = cut_lineage(own.agg(
            F.max("__n").alias("__n"), of("x", "__mn", "__xmn"), of("x", "__mx", "__xmx"), of("y", "__mn", "__ymn"),
            of("y", "__mx", "__ymx"), of("x", "__h", "__hx"), of("y", "__h", "__hy")))
    else:
        stats = vals.agg(F.count(F.lit(1)).alias("__n"),
                         F.min("__x").alias("__xmn"), F.max("__x").alias("__xmx"),
                         F.min("__y").alias("__ymn"), F.max("__y").alias("__ymx"))
        stats = stats.withColumn("__hx", F.lit(h[0] / 4.0)).withColumn("__hy", F.lit(h[1] / 4.0))
    if bins is None:
        pairs = vals.groupBy("__x", "__y").agg(F.count(F.lit(1)).alias("__w"))
    else:
        pairs = _bilinear_bins(vals, stats, bins)
    withs = attach_scalars(pairs, stats)
    step = lambda lo, hi: (F.col(hi) - F.col(lo)) / F.lit(n - 1)
    # stage 1: per distinct x and grid row j, the summed y-kernel
    gy = F.col("__ymn") + F.col("j") * step("__ymn", "__ymx")
    uy = (gy - F.col("__y")) / F.col("__hy")
    per_x = withs.select("__x", "__w", "__y", "__ymn", "__ymx", "__hy",
                         F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j")) \
        .groupBy("__x", "j").agg(F.sum(F.col("__w") * F.exp(F.lit(-0.5) * uy * uy)).alias("__by"))
    # stage 2: combine with the x-kernel on grid column i
    withx = attach_scalars(per_x, stats)
    gx = F.col("__xmn") + F.col("i") * step("__xmn", "__xmx")
    ux = (gx - F.col("__x")) / F.col("__hx")
    z = withx.select("__x", "j", "__by", "__n", "__xmn", "__xmx", "__ymn", "__ymx", "__hx", "__hy",
                     F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")) \
        .groupBy("i", "j", "__n", "__xmn", "__xmx", "__ymn", "__ymx", "__hx", "__hy") \
        .agg(F.sum(F.exp(F.lit(-0.5) * ux * ux) * F.col("__by")).alias("__s"))
    return z.select(
        "i", "j", gx.alias("x"), gy.alias("y"),
        (F.col("__s") / (F.col("__n") * F.col("__hx") * F.col("__hy") * F.lit(2 * math.pi)))
        .alias("density"))


def pretty_step(low: Column, high: Column, n: int) -> Column:
    """The step of about ``n`` round levels between two numbers: 1, 2, 5 or 10 times a power of ten.

    The rule of R's ``pretty``: the next larger step is taken if the cell is
    nearer to it, with a bias of 1.5 (2.75 at the step to 5).
    """
    cell = (high - low) / F.lit(n)
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    return base * (F.when(10 * base - cell < 1.5 * (cell - 5 * base), 10)
                   .when(5 * base - cell < 2.75 * (cell - 2 * base), 5)
                   .when(2 * base - cell < 1.5 * (cell - base), 2).otherwise(1))


#: Corners of a grid cell, counter-clockwise from the lower left; edge k joins corner k and the next.
_CORNERS = ((0, 0), (1, 0), (1, 1), (0, 1))


def _crossed(case: int, centre: bool) -> list[tuple[int, int]]:
    """The pairs of edges that a level line joins in a cell.

    Bit k of ``case`` says whether corner k lies at or above the level.  In a
    saddle the line cuts off the two corners that differ from the cell's centre.
    """
    up = [bool(case >> k & 1) for k in range(4)]
    cut = [k for k in range(4) if up[k] != up[(k + 1) % 4]]
    if len(cut) < 4:
        return [tuple(cut)] if cut else []
    return [(0, 1), (2, 3)] if up[0] == centre else [(0, 3), (1, 2)]


def contour_lines(surface: DataFrame, levels: int | Sequence[float] = 10, value: str = "density") -> DataFrame:
    """VIZ8: level lines of a surface on a grid, by marching squares.

    ``surface`` has one row per grid point ``(i, j, x, y, value)``.  Output, one
    row per piece of a line: ``(level, i, j, edge0, edge1, x0, y0, x1, y1)``;
    (i, j) is the cell's lower left point, the ends lie on two of its edges (0
    lower, 1 right, 2 upper, 3 left), where the value is interpolated linearly.
    Neighbouring cells have the same point on their common edge, so pieces join
    without gaps.  ``levels`` is a list, or a number of round levels wanted.
    """
    z = F.col(value)
    corners = [F.struct((F.col("i") - di).alias("i"), (F.col("j") - dj).alias("j"), F.lit(k).alias("k"),
                        F.col("x"), F.col("y"), z.alias("z")) for k, (di, dj) in enumerate(_CORNERS)]
    cells = (surface.where(z.isNotNull()).select(F.inline(F.array(*corners))).groupBy("i", "j")
             .agg(F.count(F.lit(1)).alias("__n"), F.min("x").alias("__xl"), F.max("x").alias("__xr"),
                  F.min("y").alias("__yl"), F.max("y").alias("__yu"),
                  *[F.max(F.when(F.col("k") == k, F.col("z"))).alias(f"__z{k}") for k in range(4)])
             .where("__n = 4").drop("__n"))
    if isinstance(levels, int):
        span = surface.agg(F.min(z).alias("__lo"), F.max(z).alias("__hi")).where("__hi > __lo")
        step = pretty_step(F.col("__lo"), F.col("__hi"), levels)
        places = F.sequence(F.floor(F.col("__lo") / step + 1e-7), F.ceil(F.col("__hi") / step - 1e-7))
        wanted = span.select(F.transform(places, lambda k: k * step).alias("__levels"))
    else:
        wanted = surface.agg(F.array(*[F.lit(float(v)) for v in levels]).alias("__levels"))
    # one row holds all levels, and a cell's lines need no other cell
    at = attach_scalars(cells, wanted).withColumn("level", F.explode("__levels"))
    level, zs = F.col("level"), [F.col(f"__z{k}") for k in range(4)]

    def between(a: Column, b: Column, za: Column, zb: Column) -> Column:
        return a + F.try_divide(level - za, zb - za) * (b - a)

    xl, xr, yl, yu = (F.col(c) for c in ("__xl", "__xr", "__yl", "__yu"))
    ends = [(between(xl, xr, zs[0], zs[1]), yl), (xr, between(yl, yu, zs[1], zs[2])),
            (between(xl, xr, zs[3], zs[2]), yu), (xl, between(yl, yu, zs[0], zs[3]))]
    case = sum((F.when(v >= level, 1 << k).otherwise(0) for k, v in enumerate(zs)), F.lit(0))
    case = case + F.when((zs[0] + zs[1] + zs[2] + zs[3]) / 4 >= level, 16).otherwise(0)
    none = F.array().cast("array<struct<edge0:int,edge1:int>>")
    table = F.array(*[F.array(*[F.struct(F.lit(a).alias("edge0"), F.lit(b).alias("edge1")) for a, b in pairs])
                      if pairs else none for c in range(32) for pairs in [_crossed(c & 15, c > 15)]])
    found = at.select("level", "i", "j", F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ends])
                      .alias("__e"), F.inline(F.get(table, case)))
    first, second = F.get("__e", F.col("edge0")), F.get("__e", F.col("edge1"))
    return found.select("level", "i", "j", "edge0", "edge1", first["x"].alias("x0"), first["y"].alias("y0"),
                        second["x"].alias("x1"), second["y"].alias("y1"))


def density_contours(df: DataFrame, x: str, y: str, n: int = 50, levels: int | Sequence[float] = 10,
                     h: tuple[float, float] | None = None, bins: int | None = 128) -> DataFrame:
    """VIZ8: level lines of the 2-D density (:func:`density_2d`), see :func:`contour_lines`.

    The grid of n × n points is computed once and kept; everything after it is
    as large as the grid.
    """
    return contour_lines(cut_lineage(density_2d(df, x, y, n, h, bins=bins)), levels)


# --------------------------------------------------------------------------
# lines, means, areas (VIZ11-VIZ15, VIZ19)
# --------------------------------------------------------------------------


def lm_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """VIZ11: least-squares line per group.

    ``(by..., n, slope, intercept, r2, mean_x, sxx, syy, sxy)`` — the sums
    needed for a confidence band as well; all from one mergeable pass.
    """
    vx, vy = _num(x), _num(y)
    aggs = [F.regr_count(vy, vx).alias("n"), F.regr_slope(vy, vx).alias("slope"),
            F.regr_intercept(vy, vx).alias("intercept"), F.regr_r2(vy, vx).alias("r2"),
            F.regr_avgx(vy, vx).alias("mean_x"), F.regr_sxx(vy, vx).alias("sxx"),
            F.regr_syy(vy, vx).alias("syy"), F.regr_sxy(vy, vx).alias("sxy")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def lm_band(df: DataFrame, x: str, y: str, by: Sequence[str] = (), points: int = 80,
            level: float = 0.95, critical: float | None = None) -> DataFrame:
    """VIZ11: the fitted line with its confidence band on ``points`` evenly spaced x.

    ``(by..., index, x, fit, lower, upper)``; the band is ``fit ± t · s ·
    √(1/n + (x - mean)²/Sxx)`` with ``s² = (Syy - slope·Sxy)/(n - 2)``, all from
    one mergeable pass.  ``t`` is Student's quantile for each group's own n - 2
    degrees of freedom, so that the band covers the line with probability
    ``level`` in small groups too; ``critical`` puts another number in its place.
    Groups with fewer than three points or constant x have a NULL band.
    """
    if points < 2:
        raise ValueError("points must be at least 2")
    vx, vy = _num(x), _num(y)
    known = F.when(vy.isNotNull(), vx)
    aggs = [F.regr_count(vy, vx).alias("__n"), F.regr_slope(vy, vx).alias("__b"),
            F.regr_intercept(vy, vx).alias("__a"), F.regr_avgx(vy, vx).alias("__m"),
            F.regr_sxx(vy, vx).alias("__sxx"), F.regr_syy(vy, vx).alias("__syy"),
            F.regr_sxy(vy, vx).alias("__sxy"), F.min(known).alias("__mn"), F.max(known).alias("__mx")]
    lines = _stats_of(df, list(by), aggs).where("__n > 0")
    factor = t_quantile(level, F.col("__n") - 2) if critical is None else F.lit(float(critical))
    lines = lines.withColumn("__t", factor)
    grid = lines.withColumn("index", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("__mn") + F.col("index") * (F.col("__mx") - F.col("__mn")) / F.lit(points - 1))
    fit = F.col("__a") + F.col("__b") * F.col("x")
    residual = F.greatest(F.col("__syy") - F.col("__b") * F.col("__sxy"), F.lit(0.0))
    variance = F.when((F.col("__n") > 2) & (F.col("__sxx") > 0),
                      F.try_divide(residual, F.col("__n") - 2) * (
                          F.try_divide(F.lit(1.0), F.col("__n"))
                          + F.try_divide(F.pow(F.col("x") - F.col("__m"), 2), F.col("__sxx"))))
    half = F.col("__t") * F.sqrt(variance)
    return grid.select(*by, "index", "x", fit.alias("fit"), (fit - half).alias("lower"),
                       (fit + half).alias("upper"))


def group_means(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                suffix: str = "_avg") -> DataFrame:
    """VIZ12/VIZ13: mean of several columns per group, one pass."""
    return df.groupBy(*keys).agg(*[F.avg(_num(v)).alias(v + suffix) for v in values])


def line_series(df: DataFrame, series: Sequence[str], x: str, y: str,
                agg: str = "avg") -> DataFrame:
    """VIZ14: one point per (series, x), ordered along x within each series."""
    fn = {"avg": F.avg, "sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[agg]
    return (df.groupBy(*series, x).agg(fn(F.col(y)).alias(y))
              .orderBy(*series, x))


def stacked_area(df: DataFrame, x: str, series: str, y: str) -> DataFrame:
    """VIZ15: band limits of a stacked area chart from ``(x, series, y)`` rows.

    ``ymax`` is the running sum of ``y`` over the series order within each x,
    ``ymin = ymax - y``.  The input is an aggregated table (one row per x and
    series), so each window partition holds one x's series only.
    """
    w = Window.partitionBy(x).orderBy(series).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(x, series, y, F.sum(y).over(w).alias("ymax")) \
        .withColumn("ymin", F.col("ymax") - F.col(y))


def scatter_points(df: DataFrame, cols: Sequence[str], every: int = 1, key: str | None = None) -> DataFrame:
    """VIZ16: the points of a scatter plot — all of them, or a repeatable part.

    With ``every`` > 1 only rows whose integer ``key`` is divisible by it are
    kept: a fixed share, chosen by arithmetic that any engine can repeat.
    """
    if every < 1 or (every > 1 and key is None):
        raise ValueError("every must be positive, and needs a key beyond 1")
    rows = df if every == 1 else df.where(F.col(key) % every == 0)
    return rows.select(*cols)


def bucket_means(df: DataFrame, score: str, value: str, by: Sequence[str] = (),
                 mode: str = "gapfree") -> DataFrame:
    """VIZ19: mean of ``value`` per score range (FN6) and group, with the range order."""
    b = range_bucket(score, mode)
    keyed = df.select(*by, b.alias("range"), _num(value).alias("__y"))
    return (keyed.groupBy("range", *by)
                 .agg(F.avg("__y").alias(value + "_avg"), F.count(F.lit(1)).alias("n"))
                 .withColumn("range_order", range_bucket_order(F.col("range"))))


# --------------------------------------------------------------------------
# pairs matrix (VIZ18)
# --------------------------------------------------------------------------


def _panel_counts(df: DataFrame, numeric: list[str], categorical: list[str], nbins: int,
                  stats: DataFrame | None) -> DataFrame:
    """(var1, var2, kind, level1, level2, __n): histogram bins and level counts of a pairs plot.

    One aggregate whose grouping sets are the panels; ``stats`` holds each
    numeric column's range as ``__mn<i>`` and ``__mx<i>``.
    """
    def bin_of(i: int) -> Column:
        v, mn, mx = _num(numeric[i]), F.col(f"__mn{i}"), F.col(f"__mx{i}")
        raw = F.greatest(F.lit(0), F.ceil(F.lit(nbins) * ((v - mn) / (mx - mn))) - 1).cast("int")
        return F.when(v.isNotNull(), F.when(mx == mn, F.lit(0)).otherwise(raw)).cast("string")

    names = [f"__b{i}" for i in range(len(numeric))] + [f"__g{j}" for j in range(len(categorical))]
    rows = df.select(*dict.fromkeys(numeric + categorical))
    if stats is not None:
        rows = attach_scalars(rows, stats)
    rows = rows.select(*[bin_of(i).alias(f"__b{i}") for i in range(len(numeric))],
                       *[F.col(c).cast("string").alias(f"__g{j}") for j, c in enumerate(categorical)])
    nul = F.lit(None).cast("string")
    panels = [([f"__b{i}"], c, c, "hist") for i, c in enumerate(numeric)]
    panels += [([f"__g{i}"] + [f"__g{j}"] * (j > i), a, categorical[j], "count")
               for i, a in enumerate(categorical) for j in range(i, len(categorical))]
    counted = rows.groupingSets([keys for keys, *_ in panels], *names).agg(
        F.grouping_id().alias("__id"), F.count(F.lit(1)).alias("__n"))

    def left_out(keys: list[str]) -> int:       # grouping_id: one bit per column, the first is the highest
        return sum(1 << (len(names) - 1 - k) for k, name in enumerate(names) if name not in keys)

    panel = F.coalesce(*[
        F.when(F.col("__id") == left_out(keys), F.struct(
            F.lit(var1).alias("var1"), F.lit(var2).alias("var2"), F.lit(kind).alias("kind"),
            F.col(keys[0]).alias("level1"), (F.col(keys[1]) if len(keys) > 1 else nul).alias("level2")))
        for keys, var1, var2, kind in panels])
    return (counted.select(panel.alias("__p"), "__n").select("__p.*", "__n")
            .where("kind = 'count' or level1 is not null"))


def pair_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                nbins: int = 10, method: str = "exact") -> DataFrame:
    """VIZ18: the statistic of every panel of a mixed-type pairs plot, long form.

    ``(var1, var2, kind, level1, level2, value)``:

    * numeric × numeric → ``corr``;
    * numeric diagonal → ``hist`` (``nbins`` equal-width counts, level1 = bin);
    * categorical × categorical → ``count`` per level pair; diagonal → counts;
    * numeric × categorical → ``q1``/``median``/``q3`` of the numeric per level.

    Panels share passes whatever the number of columns: one aggregate for
    every correlation and range, one aggregate by grouping sets for all
    histograms and categorical counts, and one quantile plan for every
    numeric-by-level box.
    """
    numeric, categorical = list(numeric), list(categorical)
    nul = F.lit(None).cast("string")
    parts: list[DataFrame] = []
    counted: list[DataFrame] = []
    stats = None
    if numeric:
        k = len(numeric)
        aggs = [e for i, c in enumerate(numeric)
                for e in (F.min(_num(c)).alias(f"__mn{i}"), F.max(_num(c)).alias(f"__mx{i}"))]
        aggs += [safe_corr(_num(numeric[i]), _num(numeric[j])).alias(f"__c{i}_{j}")
                 for i in range(k) for j in range(i + 1, k)]
        stats = df.agg(*aggs)
        corr_rows = [F.struct(F.lit(numeric[i]).alias("var1"), F.lit(numeric[j]).alias("var2"),
                              F.lit("corr").alias("kind"), nul.alias("level1"), nul.alias("level2"),
                              F.col(f"__c{min(i, j)}_{max(i, j)}").alias("value"))
                     for i in range(k) for j in range(k) if i != j]
        if corr_rows:
            parts.append(stats.select(F.inline(F.array(*corr_rows))))
        # every bin of every histogram, also those without rows
        counted.append(stats.select(F.explode(F.array(*[
            F.when(F.col(f"__mn{i}").isNotNull(), F.lit(c)) for i, c in enumerate(numeric)]))
            .alias("var1")).where(F.col("var1").isNotNull())
            .select("var1", F.col("var1").alias("var2"), F.lit("hist").alias("kind"),
                    F.explode(F.sequence(F.lit(0), F.lit(nbins - 1)).cast("array<string>")).alias("level1"),
                    nul.alias("level2"), F.lit(0).cast("long").alias("__n")))
    if numeric or categorical:
        counted.append(_panel_counts(df, numeric, categorical, nbins, stats))
        panels = ["var1", "var2", "kind", "level1", "level2"]
        parts.append(reduce(DataFrame.unionByName, counted).groupBy(*panels)
                     .agg(F.sum("__n").cast("double").alias("value")))
    if numeric and categorical:
        boxes = df.select(F.explode(F.array(*[
            F.struct(F.lit(v).alias("var1"), F.lit(cat).alias("var2"),
                     F.col(cat).cast("string").alias("level2"), _num(v).alias("x"))
            for cat in categorical for v in numeric])).alias("__e")).select("__e.*")
        qs = group_quantiles(boxes, "x", [0.25, 0.5, 0.75], ["var1", "var2", "level2"], method)
        parts.append(qs.select("var1", "var2", "level2", F.inline(F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.col("__qs")[j].alias("value"))
            for j, kind in enumerate(("q1", "median", "q3"))])))
            .withColumn("level1", nul))
    cols = ["var1", "var2", "kind", "level1", "level2", "value"]
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out
