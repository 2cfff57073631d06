"""Projection, filters, missing data and table profile (PRJ*, FLT*, NA*, ACT*).

Everything here is a narrow transformation (no shuffle) except the profile
and count helpers, which are single-pass global aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.scalar import if_else, safe_cast
from tabula.plans.strategy import attach_scalars, cut_lineage

# --------------------------------------------------------------------------
# projection (PRJ1-PRJ13)
# --------------------------------------------------------------------------


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """PRJ5: columns by 1-based position, as R indexes them."""
    cols = df.columns
    for p in positions:
        if p < 1 or p > len(cols):
            raise IndexError(f"column position {p} outside 1..{len(cols)}")
    return df.select(*[df[cols[p - 1]] for p in positions])


def select_sorted(df: DataFrame) -> DataFrame:
    """PRJ6: columns in name order."""
    return df.select(*sorted(df.columns))


def subset(df: DataFrame, predicate: Column | str | None = None,
           select: Sequence[str | Column] | None = None) -> DataFrame:
    """PRJ3/PRJ4: ``subset(df, predicate, select=cols)`` — filter, then project.

    The filter is applied first so it can be pushed into the scan together with
    the pruned column list.
    """
    out = df if predicate is None else df.where(predicate)
    return out.select(*select) if select else out


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """PRJ7/PRJ8: add or overwrite several columns in one projection."""
    return df.withColumns(dict(columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ9: rename several columns at once."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise KeyError(f"no such columns: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ10: drop columns (unknown names are ignored, as in Spark)."""
    return df.drop(*cols)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """PRJ11: cast several columns; text that does not convert becomes NULL."""
    return df.withColumns({c: safe_cast(c, t) for c, t in types.items()})


def share_of_total(df: DataFrame, count_col: str = "count",
                   name: str = "percentage") -> DataFrame:
    """PRJ13/STA10: each row's share (0..1) of the column total.

    The total is a one-row global aggregate attached by a broadcast cross join,
    so the grouped table is not shuffled and nothing goes through the driver.
    """
    total = df.agg(F.sum(count_col).alias("__total"))
    return (attach_scalars(df, total)
            .withColumn(name, F.col(count_col) / F.col("__total"))
            .drop("__total"))


# --------------------------------------------------------------------------
# filters (FLT1-FLT9)
# --------------------------------------------------------------------------


def not_nan(col: str | Column) -> Column:
    """FLT7: ``!isNaN(x)`` — NULL rows are kept (only NaN is removed)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~F.isnan(c) | c.isNull()


def non_empty(col: str | Column) -> Column:
    """FLT8: text different from ``""`` (NULL rows drop out, as in SQL)."""
    c = F.col(col) if isinstance(col, str) else col
    return c != F.lit("")


def contains_any(col: str | Column, patterns: Iterable[str]) -> Column:
    """FLT5: ``col LIKE p1 OR col LIKE p2 ...`` (case-sensitive)."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for p in patterns:
        e = c.like(p)
        out = e if out is None else (out | e)
    return out


# --------------------------------------------------------------------------
# missing data (NA1-NA9)
# --------------------------------------------------------------------------


def drop_missing(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None,
                 min_non_nulls: int | None = None) -> DataFrame:
    """NA1-NA4: drop rows by their NULL count (``dropna``).

    ``how="any"`` drops a row with any NULL, ``"all"`` only when every column
    (of ``subset``) is NULL, ``min_non_nulls=k`` keeps rows with at least k
    non-NULL values.  NaN counts as missing for numeric columns, as in Spark.
    """
    return df.dropna(how=how, thresh=min_non_nulls,
                     subset=list(subset) if subset is not None else None)


def fill_missing(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """NA5/NA6: replace NULL (and NaN in numeric columns).

    A scalar fills the columns of its own kind only (a number fills numeric
    columns, text stays NULL); a dict fills per column.
    """
    if isinstance(value, Mapping):
        return df.fillna(dict(value))
    return df.fillna(value, subset=list(subset) if subset is not None else None)


def replace_blank(df: DataFrame, col: str, replacement: str = "Unknown") -> DataFrame:
    """NA7: ``ifelse(x == "", replacement, x)``; NULL stays NULL."""
    c = F.col(col)
    return df.withColumn(col, if_else(c == "", F.lit(replacement), c))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NA8: number of NULL values per column, long form ``(column, nulls)``.

    One aggregation pass computes every count; the one-row result is unpivoted.
    """
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls")


def null_group_count(df: DataFrame, value_col: str, by: Sequence[str],
                     name: str = "nulls") -> DataFrame:
    """NA9: rows whose ``value_col`` is NULL, counted per group."""
    return (df.where(F.col(value_col).isNull())
              .groupBy(*by).agg(F.count(F.lit(1)).alias(name)))


# --------------------------------------------------------------------------
# dimensions and profile (ACT5, ACT6)
# --------------------------------------------------------------------------


def table_dims(df: DataFrame) -> DataFrame:
    """ACT5: one row ``(n_rows, n_cols)``; the row count is a distributed count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long"))


def column_profile(df: DataFrame, preview: int = 0) -> DataFrame:
    """ACT6 (``str``/``dtypes``): one row per column.

    ``(position, column, data_type, non_null, distinct_approx[, first_values])``
    — the counts come from one aggregation pass (HyperLogLog++ for the
    distinct estimate, so the pass needs bounded memory whatever the column
    cardinality).  ``preview=k`` adds the first ``k`` values of each column as
    text, read from a ``limit(k)`` of the table (which ``k`` rows is up to the
    scan order, as with ``str``).
    """
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        aggs.append(F.count(F.col(f.name)).alias(f"n{i}"))
        aggs.append(F.approx_count_distinct(F.col(f.name)).alias(f"d{i}"))
    wide = df.agg(*aggs)
    if preview:
        heads = df.limit(preview).agg(*[
            F.collect_list(F.coalesce(F.col(f.name).cast("string"), F.lit("NA"))).alias(f"h{i}")
            for i, f in enumerate(fields)])
        wide = attach_scalars(wide, heads)
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f"n{i}").alias("non_null"),
                     F.col(f"d{i}").alias("distinct_approx"),
                     *([F.col(f"h{i}").alias("first_values")] if preview else []))
            for i, f in enumerate(fields)]
    return wide.select(F.inline(F.array(*rows)))


def with_cache(df: DataFrame, fn: Callable[[DataFrame], DataFrame],
               storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """ACT7: keep ``df`` cached while ``fn`` derives a result from it, then release it.

    The recipes cache a table before several actions on it.  Here the result
    of ``fn`` (meant to be small, e.g. several aggregates) is materialised by a
    reliable checkpoint into the shared checkpoint folder before the cache is
    dropped, so the returned DataFrame neither holds the cache nor depends on
    it.  Spilling to disk (``MEMORY_AND_DISK``) keeps large inputs safe.
    """
    cached = df.persist(storage_level)
    try:
        return cut_lineage(fn(cached))
    finally:
        cached.unpersist()
