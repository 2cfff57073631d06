"""Joins (JOIN1-JOIN4).

Join strategy is left to Catalyst/AQE (broadcast-hash when a side is small at
runtime, sort-merge otherwise, skew splitting on hot keys) except where a side
has a size known in advance: one-row statistics and grids, which are
broadcast explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators.hotkeys import copy_rows, hot_keys, split_rows
from tabula.plans.strategy import attach_scalars


def join_drop_key(left: DataFrame, right: DataFrame, key: str | Sequence[str],
                  how: str = "inner", salt_buckets: int | None = None,
                  split_hot: bool = False) -> DataFrame:
    """JOIN1: equi-join that keeps a single copy of the key column(s).

    The strategy is Catalyst's (broadcast-hash for a small side, sort-merge
    otherwise, AQE splitting skewed partitions at run time).  With
    ``split_hot`` the left side's hot keys are found first
    (:mod:`tabula.operators.hotkeys`): their left rows are dealt to as many
    parts as their share is worth, and only their right rows are copied, once
    per part.  ``salt_buckets`` does the same and sets the share above which a
    key is hot, one ``salt_buckets``-th of the rows.  ``inner`` and ``left``
    joins only, where copying right rows keeps the result exact.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not (salt_buckets or split_hot):
        return left.join(right, keys, how)
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("split joins copy right rows: inner or left joins only")
    hot = hot_keys(left, keys, salt_buckets)
    return (split_rows(left, keys, hot).join(copy_rows(right, keys, hot), [*keys, "__part"], how)
            .drop("__part"))


def merge(left: DataFrame, right: DataFrame, by: str | Sequence[str],
          suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """JOIN2: ``merge(x, y, by=...)`` keeping both key copies, suffixed.

    Every column present on both sides (keys included) gets the left / right
    suffix, so the result has no ambiguous names.
    """
    keys = [by] if isinstance(by, str) else list(by)
    common = set(left.columns) & set(right.columns)
    lx = left.select(*[F.col(c).alias(c + suffixes[0]) if c in common else F.col(c)
                       for c in left.columns])
    ry = right.select(*[F.col(c).alias(c + suffixes[1]) if c in common else F.col(c)
                        for c in right.columns])
    cond = None
    for k in keys:
        e = lx[k + suffixes[0]] == ry[k + suffixes[1]]
        cond = e if cond is None else (cond & e)
    return lx.join(ry, cond, "inner")


def with_scalar_stats(df: DataFrame, aggs: Mapping[str, object]) -> DataFrame:
    """JOIN3: compute global statistics and attach them to every row.

    Replaces "collect min/max to the client, then use them as literals": the
    one-row aggregate is broadcast and joined in the same plan.
    """
    stats = df.agg(*[e.alias(n) for n, e in aggs.items()])
    return attach_scalars(df, stats)


def grid(df: DataFrame, axes: Mapping[str, tuple[str, int]]) -> DataFrame:
    """JOIN4: ``expand.grid`` of evenly spaced points spanning each column's range.

    ``axes`` maps an output name to ``(source column, number of points)``.
    The grid is generated from the one-row min/max aggregate by ``sequence`` +
    ``explode`` (a generator, no join); its size is the product of the point
    counts, an argument, not a function of the data size.
    """
    aggs = []
    for name, (col, _) in axes.items():
        aggs += [F.min(col).alias(f"__lo_{name}"), F.max(col).alias(f"__hi_{name}")]
    out = df.agg(*aggs)
    for name, (col, n) in axes.items():
        if n < 1:
            raise ValueError("grid needs at least one point per axis")
        idx = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        step = (hi - lo) / F.lit(max(n - 1, 1))
        out = out.withColumn(f"__i_{name}", idx).withColumn(
            name, lo + F.col(f"__i_{name}") * step)
    return out.select(*[F.col(f"__i_{n}").alias(f"{n}_index") for n in axes], *axes.keys())
