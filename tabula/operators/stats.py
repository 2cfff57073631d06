"""Statistics on tables (STA1-STA13).

All statistics are distributed aggregations that return small tables; none
collects rows to the driver.  Quantiles come in two kinds: exact ones
(``exact`` interpolates as R type 7, ``disc`` takes an element of the data),
by the mergeable passes of :mod:`tabula.operators.selection`, and
``approx``, Spark's Greenwald-Khanna sketch, only when the caller asks for it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.selection import exact_quantiles, select_ranks
from tabula.plans.strategy import attach_scalars, cut_lineage, join_group_stats

DEFAULT_ACCURACY = 10_000


# --------------------------------------------------------------------------
# summaries (STA1)
# --------------------------------------------------------------------------


def describe(df: DataFrame, *cols: str) -> DataFrame:
    """STA1: Spark's ``describe`` — count, mean, stddev, min, max as text."""
    return df.describe(*cols)


def summary_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """STA1 (typed): one row per numeric column with count, mean, stddev, min, max.

    One aggregation pass over all columns; the one-row result is turned into
    rows with ``inline``.
    """
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("integer", "long", "short", "byte", "float",
                                            "double", "decimal")}
    cols = [c for c in (cols or df.columns) if c in numeric]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


# --------------------------------------------------------------------------
# quantiles (STA2)
# --------------------------------------------------------------------------


_KINDS = {"exact": "cont", "disc": "disc"}


def group_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    method: str = "exact", accuracy: int = DEFAULT_ACCURACY,
                    also: Mapping[str, Column] | None = None) -> DataFrame:
    """Quantiles of one column per group: ``(by..., __n, also..., __qs array<double>)``.

    ``exact`` and ``disc`` go through :func:`exact_quantiles`; ``approx`` is one
    sketch aggregate whose memory ``accuracy`` bounds.  ``also`` names aggregates of
    ``__v`` that come from the same pass.  NULLs are ignored; groups without
    values are absent.
    """
    by = list(by)
    vals = df.select(*by, F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    if method in _KINDS:
        return exact_quantiles(vals, by, probs, _KINDS[method], also)
    if method != "approx":
        raise ValueError("method must be 'exact', 'disc' or 'approx'")
    aggs = [F.count(F.lit(1)).alias("__n"), *[c.alias(name) for name, c in (also or {}).items()],
            F.percentile_approx("__v", list(probs), accuracy).alias("__qs")]
    return vals.groupBy(*by).agg(*aggs) if by else vals.agg(*aggs).where(F.col("__n") > 0)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), method: str = "exact",
              accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """STA2: quantiles of several columns, long ``(by..., column, prob, value)``.

    All columns share one plan.  ``exact`` interpolates between order
    statistics (R type 7, SQL ``percentile_cont``); ``disc`` is the exact
    discrete quantile (SQL ``percentile_disc``); ``approx`` returns an element
    of the data within rank error ``n/accuracy``.
    """
    by = list(by)
    long = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("__x")) for c in cols])))
    q = group_quantiles(long, "__x", probs, [*by, "column"], method, accuracy)
    rows = [F.struct(F.lit(float(p)).alias("prob"), F.col("__qs")[j].alias("value"))
            for j, p in enumerate(probs)]
    return q.select(*by, "column", F.inline(F.array(*rows)))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     relative_error: float = 0.001) -> DataFrame:
    """STA2: ``approxQuantile(cols, probs, relativeError)`` as a DataFrame.

    ``relative_error`` 0 asks for exact discrete quantiles (``percentile_disc``);
    otherwise a sketch with accuracy ``1/relative_error`` is used, whose memory
    does not grow with the data.
    """
    if relative_error < 0:
        raise ValueError("relative_error must be >= 0")
    if relative_error == 0:
        return quantiles(df, cols, probs, method="disc")
    accuracy = min(max(int(math.ceil(1.0 / relative_error)), 1), 2**31 - 1)
    return quantiles(df, cols, probs, method="approx", accuracy=accuracy)


# --------------------------------------------------------------------------
# correlation, covariance (STA3-STA6)
# --------------------------------------------------------------------------


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate that is NULL (not an error) when a
    column is constant: ``cov(x, y) / (sd(x)·sd(y))`` with ``try_divide``.
    Spark's own ``corr`` divides by zero in ANSI mode on a constant column."""
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def corr_pair(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """STA3: Pearson correlation of two columns (global or per group)."""
    e = safe_corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("corr")
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def cov_pair(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """STA4: sample covariance of two columns."""
    e = F.covar_samp(F.col(x).cast("double"), F.col(y).cast("double")).alias("cov")
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 2) -> DataFrame:
    """STA5/STA6/VIZ17: correlation matrix in long form ``(var1, var2, value)``.

    All k(k-1)/2 pairs are computed in a single aggregation pass (each is a
    mergeable 6-number buffer); the diagonal is 1 (NULL for a constant
    column) and the lower triangle mirrors the upper one.
    """
    cols = list(cols)
    aggs = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(safe_corr(F.col(cols[i]).cast("double"),
                                  F.col(cols[j]).cast("double")).alias(f"c{i}_{j}"))
    aggs += [F.when(F.stddev_samp(F.col(c).cast("double")) > 0, F.lit(1.0)).alias(f"c{i}_{i}")
             for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = F.col(f"c{min(i, j)}_{max(i, j)}")
            if digits is not None:
                v = F.round(v, digits)
            rows.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                 v.cast("double").alias("value")))
    return wide.select(F.inline(F.array(*rows)))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
         variable: str = "variable", value: str = "value") -> DataFrame:
    """STA6: wide → long (``reshape2::melt``)."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), values, variable, value)


# --------------------------------------------------------------------------
# contingency tables, frequencies (STA7, STA10)
# --------------------------------------------------------------------------


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """STA7 (long): ``(a, b, count)`` for every observed pair."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """STA7: contingency table, one row per value of ``a``, one column per value of ``b``.

    The first column is named ``"{a}_{b}"`` and holds ``a`` as text, as Spark's
    ``crosstab`` does; ``values`` names the columns (as text, ``"null"`` for
    NULL); cells are counts (0 for unseen pairs).  Rows with other values of
    ``b`` are counted in the column ``"other"`` if there is one in ``values``
    and are left to :func:`crosstab_long` otherwise, which needs no names.
    """
    names = [str(v) for v in values]
    text = F.coalesce(F.col(b).cast("string"), F.lit("null"))
    if "other" in names:
        text = F.when(text.isin(names), text).otherwise(F.lit("other"))
    keyed = df.select(F.col(a).cast("string").alias(f"{a}_{b}"), text.alias("__b"))
    wide = keyed.groupBy(f"{a}_{b}").pivot("__b", names).agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=names)


def frequency_table(df: DataFrame, col: str | Sequence[str]) -> DataFrame:
    """STA10: counts per value with the share of all rows (0..1)."""
    keys = [col] if isinstance(col, str) else list(col)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("__total"))
    return (attach_scalars(counts, total)
            .withColumn("percentage", F.col("count") / F.col("__total")).drop("__total"))


# --------------------------------------------------------------------------
# histograms (STA8, STA9)
# --------------------------------------------------------------------------


def histogram(df: DataFrame, col: str, nbins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """STA8: equal-width histogram ``(by..., bin, lower, upper, centroid, count)``.

    Bins split ``[min, max]`` into ``nbins`` right-closed intervals (the first
    also closed on the left).  Empty bins are present with count 0.  Per
    group, the minimum and maximum of that group are used.
    """
    if nbins < 1:
        raise ValueError("nbins must be positive")
    by = list(by)
    x = F.col(col).cast("double")
    vals = df.select(*by, x.alias("__x")).where(F.col("__x").isNotNull())
    stats = vals.groupBy(*by).agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx")) \
        if by else vals.agg(F.min("__x").alias("__mn"), F.max("__x").alias("__mx"))
    withs = join_group_stats(vals, stats, by)
    mn, mx = F.col("__mn"), F.col("__mx")
    raw = F.ceil(F.lit(nbins) * ((F.col("__x") - mn) / (mx - mn))) - 1
    binned = withs.select(*by, F.when(mx == mn, F.lit(0))
                          .otherwise(F.greatest(F.lit(0), raw).cast("int")).alias("bin"))
    counts = binned.groupBy(*by, F.col("bin").alias("__cbin")).agg(F.count(F.lit(1)).alias("count"))
    # every bin of every group: groups × nbins rows, generated from the stats
    frame = stats.where(F.col("__mn").isNotNull()).select(*by, "__mn", "__mx",
                         F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"))
    w = (mx - mn) / F.lit(nbins)
    cond = [frame[k].eqNullSafe(counts[k]) for k in by] + [frame["bin"] == counts["__cbin"]]
    out = frame.join(counts, cond, "left").select(
        *[frame[k] for k in by], frame["bin"],
        (mn + F.col("bin") * w).alias("lower"),
        (mn + (F.col("bin") + 1) * w).alias("upper"),
        (mn + (F.col("bin") + F.lit(0.5)) * w).alias("centroid"),
        F.coalesce(counts["count"], F.lit(0).cast("long")).alias("count"))
    return out


def bivariate_histogram(df: DataFrame, x: str, y: str, nbins: int = 100) -> DataFrame:
    """STA9: two-way binned frequency ``(x_bin, y_bin, count)``.

    Bin edges run from ``floor(min)`` to ``ceiling(max)`` in ``nbins`` points,
    so the width is ``(ceil(max) - floor(min)) / (nbins - 1)``; a value's bin
    is ``ceil((v - min) / width)`` with the raw minimum, and bin 0 is merged
    into bin 1.  A constant column (width 0) puts everything in bin 1.
    """
    if nbins < 2:
        raise ValueError("nbins must be at least 2")
    vx, vy = F.col(x).cast("double"), F.col(y).cast("double")
    stats = df.agg(F.min(vx).alias("__xmn"), F.max(vx).alias("__xmx"),
                   F.min(vy).alias("__ymn"), F.max(vy).alias("__ymx"))
    withs = attach_scalars(df.select(vx.alias("__x"), vy.alias("__y")), stats)

    def bin_of(v: str, mn: str, mx: str) -> Column:
        width = (F.ceil(F.col(mx)) - F.floor(F.col(mn))) / F.lit(nbins - 1)
        idx = F.ceil((F.col(v) - F.col(mn)) / width)
        return F.when(width == 0, F.lit(1).cast("long")).when(idx == 0, F.lit(1).cast("long")) \
            .otherwise(idx)

    binned = withs.where(F.col("__x").isNotNull() & F.col("__y").isNotNull()).select(
        bin_of("__x", "__xmn", "__xmx").alias("x_bin"),
        bin_of("__y", "__ymn", "__ymx").alias("y_bin"))
    return binned.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------------------
# sampling and splits (STA11-STA13)
# --------------------------------------------------------------------------


def sample_fraction(df: DataFrame, fraction: float, seed: int | None = None,
                    with_replacement: bool = False) -> DataFrame:
    """STA11: Bernoulli (or Poisson with replacement) sample; size is approximate."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None
                 ) -> list[DataFrame]:
    """STA12: disjoint random parts whose sizes follow ``weights``."""
    return df.randomSplit(list(weights), seed)


def split_by_except(df: DataFrame, fraction: float, seed: int | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """STA13: ``train = sample``; ``test = except(df, train)``.

    ``except`` is EXCEPT DISTINCT: duplicates collapse and a test row equal to
    any train row is removed, so the parts are disjoint by construction.  For
    tables with duplicate rows :func:`random_split` keeps every row.
    """
    from tabula.operators.setops import except_rows
    train = sample_fraction(df, fraction, seed)
    return train, except_rows(df, train)


#: Hexadecimal digits of a row's draw that serve as a number: 52 bits, exact in a double.
DRAW_DIGITS = 13


def _drawn(df: DataFrame, key: Sequence[str] | None, seed: int) -> DataFrame:
    """``df`` with ``__draw``, the MD5 of seed and key in hex, the same in any layout and engine.

    With a key that names the rows the text is ``seed|key...``.  Without one
    the rows are numbered among their equals and the text is
    ``seed|number|column...``; equal rows are counted (partially before the
    shuffle) and written out again, so a row that occurs very often is no burden.
    """
    columns = df.columns

    def text(parts: list[Column]) -> Column:
        return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))

    if key is not None:
        return df.withColumn("__draw", text([F.lit(seed), *[F.col(k) for k in key]]))
    runs = (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
            .withColumn("__run", F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / 1024)))))
    last = F.least(F.col("__copies"), (F.col("__run") + 1) * 1024)
    numbered = runs.select(*columns, F.explode(F.sequence(F.col("__run") * 1024 + 1, last)).alias("__copy"))
    return numbered.withColumn("__draw", text([F.lit(seed), F.col("__copy"), *[F.col(c) for c in columns]])) \
        .drop("__copy")


def _draw_number() -> Column:
    return F.conv(F.substring("__draw", 1, DRAW_DIGITS), 16, 10).cast("double")


def sample_exact(df: DataFrame, fraction: float | None = None, rows: int | None = None,
                 seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """STA11: a repeatable sample of exactly ``rows`` rows (or ``fraction`` of them, rounded).

    The rows with the smallest draws (MD5 of seed and row) are taken, so the
    sample depends on the rows alone: not on files, partitions or engine.  The
    largest draw that belongs to it is found by rank selection, without a sort.
    ``key`` names columns that are unique for every row and saves the numbering
    of equal rows; without it all columns together name a row.
    """
    if (fraction is None) == (rows is None):
        raise ValueError("give either fraction or rows")
    drawn = _drawn(df, key, seed)
    if key is None:
        drawn = cut_lineage(drawn)      # numbers of equal rows belong to one deal
    wanted = (lambda n: F.lit(int(rows))) if rows is not None else (lambda n: F.floor(F.lit(float(fraction)) * n + 0.5))
    last = select_ranks(drawn.select(_draw_number().alias("__v")), [],
                        [lambda n: F.greatest(F.least(wanted(n), n) - 1, F.lit(0))],
                        [fraction if fraction is not None else 0.5])
    limits = last.select(F.col("__s0").alias("__last"), F.least(wanted(F.col("__n")), F.col("__n")).alias("__want"))
    placed = attach_scalars(drawn.withColumn("__number", _draw_number()), limits).where("__want > 0")
    below = placed.where("__number < __last")
    # draws that agree in all digits of the number, if any: the rest of the MD5 decides
    missing = attach_scalars(limits, below.agg(F.count(F.lit(1)).alias("__have")))
    level = placed.where("__number = __last").select(*df.columns, "__draw")
    order = Window.partitionBy(F.lit(0)).orderBy("__draw")
    level = (attach_scalars(level.withColumn("__place", F.row_number().over(order)), missing)
             .where(F.col("__place") <= F.col("__want") - F.col("__have")))
    return below.select(*df.columns).union(level.select(*df.columns))


def split_exact(df: DataFrame, weights: Sequence[float], seed: int = 0,
                key: Sequence[str] | None = None) -> list[DataFrame]:
    """STA12/STA13: disjoint parts that keep every row, duplicates included.

    A row goes where its draw falls among the running weights: the parts add up
    to the table whatever its layout, equal rows are split like any others, and
    any engine repeats the split.  Sizes follow the weights as chance has it.
    ``key`` as in :func:`sample_exact`.
    """
    total = float(sum(weights))
    if not weights or min(weights) < 0 or total <= 0:
        raise ValueError("weights must be numbers of 0 or more, not all 0")
    drawn, span = _drawn(df, key, seed), 16 ** DRAW_DIGITS
    ends = [math.floor(sum(weights[:k + 1]) / total * span) for k in range(len(weights))]
    ends[-1] = span
    number, parts, start = F.conv(F.substring("__draw", 1, DRAW_DIGITS), 16, 10).cast("bigint"), [], 0
    for end in ends:
        parts.append(drawn.where((number >= start) & (number < end)).drop("__draw"))
        start = end
    return parts


def split_report(table: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """One row about a split: ``(n, n_first, n_second, n_union, n_overlap)``.

    ``n`` is the table's rows, ``n_first`` and ``n_second`` the parts';
    ``n_union`` counts the distinct rows in either part, ``n_overlap`` those in
    both.
    """
    from tabula.operators.setops import intersect_rows
    parts = [table.agg(F.count(F.lit(1)).alias("n")), first.agg(F.count(F.lit(1)).alias("n_first")),
             second.agg(F.count(F.lit(1)).alias("n_second")),
             first.union(second).distinct().agg(F.count(F.lit(1)).alias("n_union")),
             intersect_rows(first, second).agg(F.count(F.lit(1)).alias("n_overlap"))]
    out = parts[0]
    for part in parts[1:]:
        out = attach_scalars(out, part)
    return out
