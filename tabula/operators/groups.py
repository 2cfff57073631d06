"""Grouping, aggregation and ordering (AGG1-AGG17, SRT1-SRT4).

Aggregates are written as one ``agg`` with many expressions: Spark computes
them in a single pass with a partial (map-side) aggregate before the shuffle,
so the shuffle carries one row per group and partition whatever the group
sizes — a hot group costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.functions.dates import period_start
from tabula.plans.strategy import cut_lineage


def group_agg(df: DataFrame, by: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    """AGG1-AGG5, AGG15-AGG16: named aggregates per group (global when ``by`` is empty)."""
    exprs = [e.alias(name) for name, e in aggs.items()]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def group_count(df: DataFrame, by: Sequence[str | Column], name: str = "count") -> DataFrame:
    """AGG1: rows per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def count_non_null(df: DataFrame, by: Sequence[str], col: str, name: str = "count") -> DataFrame:
    """AGG2: ``n(x)`` — non-NULL values of ``col`` per group."""
    return df.groupBy(*by).agg(F.count(F.col(col)).alias(name))


def min_max_range(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """AGG5/AGG6: minimum, maximum and range width, global or per group."""
    c = F.col(col)
    return group_agg(df, list(by), {
        "minimum": F.min(c), "maximum": F.max(c), "range": F.abs(F.max(c) - F.min(c))})


_MOMENTS = {
    "mean": F.avg,
    "variance": F.var_samp,
    "stddev": F.stddev_samp,
    "skewness": F.skewness,
    "kurtosis": F.kurtosis,
}


def moments(df: DataFrame, cols: Sequence[str], stats: Sequence[str] = tuple(_MOMENTS),
            by: Sequence[str] = ()) -> DataFrame:
    """AGG7-AGG11: mean, sample variance / sd, population skewness, excess kurtosis.

    All statistics of all columns in one pass; the result is long
    ``(by..., column, <stat>...)``, one row per input column (and group).
    """
    for s in stats:
        if s not in _MOMENTS:
            raise ValueError(f"unknown statistic {s}; choose from {list(_MOMENTS)}")
    aggs = [_MOMENTS[s](F.col(c)).alias(f"{s}__{i}") for i, c in enumerate(cols) for s in stats]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     *[F.col(f"{s}__{i}").alias(s) for s in stats])
            for i, c in enumerate(cols)]
    return wide.select(*by, F.inline(F.array(*rows)))


def count_distinct(df: DataFrame, col: str, by: Sequence[str] = (),
                   name: str = "n_distinct") -> DataFrame:
    """AGG12: exact number of distinct non-NULL values.

    Spark plans this as a two-level aggregate (distinct keys first, then the
    count), so no single task holds all values of a group.
    """
    return group_agg(df, list(by), {name: F.count_distinct(F.col(col))})


def cube_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
             grouping_id: str | None = "grouping_id") -> DataFrame:
    """AGG13: CUBE — every subset of ``keys``.

    ``grouping_id`` tells a sub-total row (key rolled up) from a NULL key.
    """
    exprs = [e.alias(n) for n, e in aggs.items()]
    if grouping_id:
        exprs.append(F.grouping_id(*keys).alias(grouping_id))
    return df.cube(*keys).agg(*exprs)


def rollup_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
               grouping_id: str | None = "grouping_id") -> DataFrame:
    """AGG14: ROLLUP — hierarchical sub-totals over ``keys`` in order."""
    exprs = [e.alias(n) for n, e in aggs.items()]
    if grouping_id:
        exprs.append(F.grouping_id(*keys).alias(grouping_id))
    return df.rollup(*keys).agg(*exprs)


def resample(df: DataFrame, date_col: str, unit: str, aggs: Mapping[str, Column],
             by: Sequence[str] = (), name: str = "period") -> DataFrame:
    """AGG17: aggregate per calendar period (day, week, month, quarter, year)."""
    keyed = df.withColumn(name, period_start(date_col, unit))
    return group_agg(keyed, [name, *by], aggs)


# --------------------------------------------------------------------------
# ordering (SRT1-SRT4)
# --------------------------------------------------------------------------


def sort_by(df: DataFrame, *cols: str | Column, descending: bool | Sequence[bool] = False) -> DataFrame:
    """SRT1/SRT2: a total, range-partitioned sort (NULLs first ascending, last
    descending); also used to order a per-group function's result before it is
    collected, instead of sorting it on the client."""
    flags = [descending] * len(cols) if isinstance(descending, bool) else list(descending)
    exprs = [(F.col(c) if isinstance(c, str) else c) for c in cols]
    return df.orderBy(*[e.desc() if d else e.asc() for e, d in zip(exprs, flags)])


def top_k(df: DataFrame, k: int, *cols: str | Column, descending: bool = True) -> DataFrame:
    """SRT3/ACT1/ACT2: first ``k`` rows by an order (``head``/``take`` made
    deterministic) — planned as ``TakeOrderedAndProject``, which keeps only
    ``k`` rows per partition before the final merge."""
    return sort_by(df, *cols, descending=descending).limit(k)


def head(df: DataFrame, n: int = 6) -> DataFrame:
    """ACT1/ACT6: the first ``n`` rows of a Parquet table in the order of its files.

    ``df`` is a table as read.  Rows are ordered by the hidden path of their
    file and their place in it, so the result does not depend on which task
    ends first; it is planned as ``TakeOrderedAndProject``, and rows beyond the
    n-th of a file never reach it.
    """
    if n < 0:
        raise ValueError("n must be 0 or more")
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    placed = df.select("*", path.alias("__path"), place.alias("__place")).where(F.col("__place") < n)
    return placed.orderBy("__path", "__place").limit(n).drop("__path", "__place")


def rank_categories(df: DataFrame, metric: str, name: str = "rank",
                    tie_break: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """SRT4: ``reorder(category, metric)`` — a dense 1-based rank of each row's metric.

    The ranks are computed on the *distinct* metric values by a distributed
    range sort with per-partition offsets, so no single task sees all values,
    and joined back by a plain equality join.
    """
    order = [F.col(metric).desc() if descending else F.col(metric).asc(),
             *[F.col(t).asc() for t in tie_break]]
    keys = [metric, *tie_break]
    distinct_vals = df.select(*keys).distinct()
    ranked = distributed_rank(distinct_vals, order, name)
    # NULL-safe match, so a NULL metric keeps its row (ranked first ascending)
    ren = ranked.select(*[F.col(k).alias(f"__r_{k}") for k in keys], name)
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(ren[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return df.join(ren, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def distributed_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Row number over a total order without a single-partition window.

    1. ``orderBy`` range-partitions and sorts the rows;
    2. each partition's size is counted (one row per partition);
    3. offsets = running sum over partitions (a table of #partitions rows,
       broadcast — bounded by the partition count);
    4. row number inside the partition + offset.
    """
    pid = "__pid"
    # materialise the sorted partitions once, so the sizes and the local row
    # numbers below are computed from the very same partitioning
    sorted_df = cut_lineage(df.orderBy(*order)).withColumn(pid, F.spark_partition_id())
    sizes = sorted_df.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.withColumn(
        "__off", F.sum("__n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)))
    local = sorted_df.withColumn("__local", F.row_number().over(Window.partitionBy(pid).orderBy(*order)))
    out = local.join(F.broadcast(offsets.select(pid, "__off")), pid)
    return (out.withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).cast("long"))
               .drop(pid, "__off", "__local"))
