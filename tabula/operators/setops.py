"""Set operations between tables (SET1-SET6).

``union``/``unionByName`` are narrow (partitions are concatenated, no
shuffle); ``subtract``/``intersect`` are DISTINCT set operations that Spark
plans as a shuffle on all columns (left-anti / left-semi join after a
distinct).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_rows(*dfs: DataFrame, check_order: bool = True) -> DataFrame:
    """SET1: ``rbind`` — stack tables with the same columns, keep duplicates.

    The recipe requires "same names and order"; that is checked here, because a
    positional union would silently coerce swapped columns.
    """
    if not dfs:
        raise ValueError("nothing to append")
    first = dfs[0].columns
    for d in dfs[1:]:
        if check_order and d.columns != first:
            raise ValueError(f"column names/order differ: {first} vs {d.columns}")
        if not check_order and sorted(d.columns) != sorted(first):
            raise ValueError(f"column names differ: {first} vs {d.columns}")
    return reduce(DataFrame.unionByName, dfs)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET4: ``unionAll`` — by position, duplicates kept."""
    if len(a.columns) != len(b.columns):
        raise ValueError("unionAll needs the same number of columns")
    return a.unionAll(b)


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET2: ``except`` — distinct rows of ``a`` not in ``b`` (EXCEPT DISTINCT).

    Spark plans EXCEPT as an anti join followed by a distinct, so the join
    itself sees every duplicate; both sides are made distinct first, so a row
    repeated a billion times reaches the join as one row (the duplicates
    collapse in the map-side partial aggregate) instead of landing in a single
    join task.
    """
    return a.distinct().subtract(b.distinct())


def intersect_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET3: ``intersect`` — distinct rows in both (INTERSECT DISTINCT).

    As for :func:`except_rows`, both sides are de-duplicated before the semi
    join so hot duplicated rows cannot skew it.
    """
    return a.distinct().intersect(b.distinct())


def append_common(x: DataFrame, y: DataFrame) -> DataFrame:
    """SET5: ``rbind.intersect`` — stack on the shared columns only, sorted by name."""
    common = sorted(set(x.columns) & set(y.columns))
    if not common:
        raise ValueError("the tables share no column")
    return x.select(*common).unionByName(y.select(*common))


def columns_outside(x: DataFrame, y: DataFrame) -> list[str]:
    """SET6 helper (``outersect``): columns in exactly one of the tables, sorted."""
    return sorted(set(x.columns) ^ set(y.columns))


def append_fill(x: DataFrame, y: DataFrame, fill: str | None = None) -> DataFrame:
    """SET6: ``rbind.fill`` — stack on all columns of both, sorted by name.

    A column missing on one side is NULL there; with ``fill`` given, missing
    *string* columns get that text instead (the recipe's ``""``).
    """
    every = sorted(set(x.columns) | set(y.columns))
    types = {f.name: f.dataType for f in x.schema.fields}
    types.update({f.name: f.dataType for f in y.schema.fields if f.name not in types})

    outside = set(columns_outside(x, y))

    def complete(d: DataFrame) -> DataFrame:
        have = set(d.columns)
        cols = []
        for c in every:
            if c in have or c not in outside:
                cols.append(F.col(c))
            elif fill is not None and isinstance(types[c], T.StringType):
                cols.append(F.lit(fill).alias(c))
            else:
                cols.append(F.lit(None).cast(types[c]).alias(c))
        return d.select(*cols)

    return complete(x).unionByName(complete(y))
