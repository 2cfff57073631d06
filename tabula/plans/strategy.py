"""Physical-strategy helpers shared by the operators.

Rules applied throughout the library:

* A side is broadcast only when its size is *proven*: a global aggregate
  (exactly one row), or a grid or list whose size is an argument.  Per-group
  statistics are joined by a plain equality join: adaptive execution broadcasts
  them if they turn out small and splits a hot group's rows otherwise.
* Hot keys are found by a bounded summary and only they are split
  (:mod:`tabula.operators.hotkeys`); parts are hashes of the row's values.
* Lineage is cut with ``DataFrame.checkpoint()`` into ``spark.checkpoint.dir``
  (a shared folder), never ``localCheckpoint``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.session import checkpoint_dir


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row table (a global aggregate) to every row.

    A global ``agg`` without ``groupBy`` returns exactly one row, so the
    broadcast has a proven size; the plan is a BroadcastNestedLoopJoin with
    one build row, i.e. a projection, and no shuffle of ``df``.
    """
    return df.crossJoin(F.broadcast(one_row))


def join_group_stats(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-group statistics (one row per key) back to the rows.

    Keys are matched null-safely, so a NULL group gets its own statistics as in
    ``groupBy``.  With no keys this is :func:`attach_scalars`.
    """
    if not keys:
        return attach_scalars(df, stats)
    side = stats.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                        *[c for c in stats.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(side[f"__k_{k}"]) for k in keys])
    return df.join(side, same).drop(*[f"__k_{k}" for k in keys])


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
