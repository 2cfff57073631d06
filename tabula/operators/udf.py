"""User functions over partitions, groups and lists (UDF1-UDF5).

User code runs in Arrow batches (``mapInPandas`` / ``applyInPandas``), never
row by row.  Two additions over the plain Spark calls:

* **schema inference** (the "collect" variants of the recipes return whatever
  the function returns): a first distributed pass runs the function on all
  batches and reports only the types of its results; types that differ between
  batches are widened (whole numbers and fractions to double, else to text);
* **hot groups**: ``applyInPandas`` hands a whole group to one task.  When the
  per-group function is decomposable (max, sum, count, min ...), pass
  ``combine``: groups that hold more than a task's share of the rows are split
  into as many parts as that share is worth (:mod:`tabula.operators.hotkeys`),
  the function runs on the parts, and the built-in aggregates in ``combine``
  merge the partial results per real group.  All other groups stay whole.  A
  function that needs its group whole has to say so (``whole_group=True``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.hotkeys import hot_keys, split_rows

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]
GroupFn = Callable[[tuple, pd.DataFrame], pd.DataFrame]

_COMBINE = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}


def _batches(fn: PandasFn) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = fn(pdf)
            if out is not None and len(out):
                yield out
    return run


def map_partitions(df: DataFrame, fn: PandasFn, schema: T.StructType | str) -> DataFrame:
    """UDF1 (``dapply``): apply ``fn`` to every Arrow batch of every partition.

    ``fn`` receives and returns a pandas DataFrame; output columns are matched
    to ``schema`` by name.  No shuffle.
    """
    return df.mapInPandas(_batches(fn), schema)


_TYPES = "position int, name string, type string"


def _types(out: pd.DataFrame) -> pd.DataFrame:
    """One row per column of a result: its place, name and Spark type (``void``: only NULLs)."""
    from pyspark.sql.pandas.types import from_arrow_schema

    if not isinstance(out, pd.DataFrame):
        raise TypeError("the function must return a pandas DataFrame")
    fields = from_arrow_schema(pa.Schema.from_pandas(out, preserve_index=False)).fields
    return pd.DataFrame([(k, f.name, f.dataType.simpleString()) for k, f in enumerate(fields)],
                        columns=["position", "name", "type"])


def _wider(kinds: set[str]) -> str:
    """One type that holds values of all the given ones."""
    kinds = kinds - {"void"}
    if len(kinds) < 2:
        return next(iter(kinds), "string")
    whole = ["tinyint", "smallint", "int", "bigint"]
    if kinds <= set(whole):
        return max(kinds, key=whole.index)
    if kinds <= {*whole, "float", "double"}:
        return "double"
    if kinds == {"date", "timestamp"}:
        return "timestamp"
    return "string"


def merged_schema(found: DataFrame, source: DataFrame) -> T.StructType:
    """The schema that a table of ``_types`` rows adds up to.

    A column that keeps an input column's name and type family keeps its exact
    input type (a nullable integer that pandas turned into fractions).
    """
    rows = found.distinct().orderBy("position", "name", "type").collect()    # columns x types
    kinds: dict[str, set[str]] = {}
    for r in rows:
        kinds.setdefault(r.name, set()).add(r.type)
    inputs = {f.name: f.dataType for f in source.schema.fields}
    columns = []
    for name, own in kinds.items():
        wide = _wider(own)
        same = inputs.get(name)
        kept = same is not None and (own - {"void"} <= {same.simpleString(), "double"} or own == {"void"}) \
            and same.simpleString() in ("bigint", "int", "smallint", "tinyint", wide)
        columns.append(f"`{name}` {same.simpleString() if kept else wide}")
    if not columns:
        raise ValueError("the function's columns cannot be learned from an empty table; pass schema")
    return source.sparkSession.createDataFrame([], ", ".join(columns)).schema


def map_partitions_inferred(df: DataFrame, fn: PandasFn,
                            schema: T.StructType | str | None = None) -> DataFrame:
    """UDF2 (``dapplyCollect``): like :func:`map_partitions` without a declared schema.

    A first pass over all batches learns the types (see :func:`merged_schema`);
    pass ``schema`` to save it.  An empty table is shown to the function as one
    empty batch.
    """
    if schema is None:
        def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = fn(pdf)
                if out is not None:
                    yield _types(out)
        found = df.mapInPandas(report, _TYPES)
        if found.limit(1).count() == 0:
            found = df.sparkSession.createDataFrame(_types(fn(df.limit(0).toPandas())), _TYPES)
        schema = merged_schema(found, df)
    return map_partitions(df, fn, schema)


def _split(df: DataFrame, keys: list[str], parts: int | None) -> DataFrame:
    return split_rows(df, keys, hot_keys(df, keys, parts))


def _part(fn: GroupFn, n_keys: int) -> GroupFn:
    """``fn`` on a part of a group."""
    def part(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(key[:n_keys], pdf.drop(columns="__part"))
    return part


def map_groups(df: DataFrame, keys: Sequence[str], fn: GroupFn, schema: T.StructType | str,
               combine: Mapping[str, str] | None = None,
               salt_buckets: int | None = None, whole_group: bool = False) -> DataFrame:
    """UDF3 (``gapply``): apply ``fn(key, pdf)`` to each group.

    With ``combine`` (output column → ``max``/``min``/``sum``/``count``) a group
    that holds more than one ``salt_buckets``-th of the rows (by default the
    session's shuffle partitions) is split into as many parts as its share is
    worth, ``fn`` runs per part, and the parts' results are merged per group,
    so no task holds a hot group.  ``whole_group=True`` is ``applyInPandas``:
    one call, and one task, a group.
    """
    keys = list(keys)
    if whole_group:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    if not combine:
        raise ValueError("pass `combine` to merge the parts of a group, or whole_group=True")
    partial = _split(df, keys, salt_buckets).groupBy(*keys, "__part").applyInPandas(_part(fn, len(keys)), schema)
    out_keys = [c for c in partial.columns if c not in combine]
    return partial.groupBy(*out_keys).agg(
        *[_COMBINE[how](F.col(c)).alias(c) for c, how in combine.items()])


def map_groups_inferred(df: DataFrame, keys: Sequence[str], fn: GroupFn,
                        combine: Mapping[str, str] | None = None,
                        salt_buckets: int | None = None, whole_group: bool = False,
                        schema: T.StructType | str | None = None) -> DataFrame:
    """UDF4 (``gapplyCollect``): :func:`map_groups` without a declared schema.

    A first pass runs the function on all groups (or their parts) and merges
    the types of the results; an empty table needs ``schema``.
    """
    keys = list(keys)
    if not (whole_group or combine):
        raise ValueError("pass `combine` to merge the parts of a group, or whole_group=True")
    if schema is None:
        run = fn if whole_group else _part(fn, len(keys))

        def report(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return _types(run(key, pdf))

        groups = df.groupBy(*keys) if whole_group else _split(df, keys, salt_buckets).groupBy(*keys, "__part")
        schema = merged_schema(groups.applyInPandas(report, _TYPES), df)
    return map_groups(df, keys, fn, schema, combine, salt_buckets, whole_group)


def map_list(items: DataFrame, keys: Sequence[str], fn: PandasFn, schema: T.StructType | str,
             tasks: int | None = None) -> DataFrame:
    """UDF5 (``spark.lapply``): run ``fn`` over a list of work items.

    ``items`` is a DataFrame of parameter rows (derived by Spark, not shipped
    from the driver), dealt by the columns that name an item to ``tasks`` tasks
    (by default the session's shuffle partitions); ``fn`` maps each batch of
    items to result rows.
    """
    dealt = items.repartition(tasks, *keys) if tasks else items.repartition(*keys)
    return map_partitions(dealt, fn, schema)
