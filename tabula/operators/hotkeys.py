"""Hot keys: which keys hold more rows than one task should, and how many parts they need.

One aggregate over the hashed keys finds them: ``approx_top_k`` keeps a bounded
number of counters, merges them between tasks and returns the frequent items.
A key whose share exceeds one task's is *hot*; it is dealt to as many parts as
its share is worth.  All other keys, the bulk of any table, stay whole and are
never copied.

Parts are computed from the row's values, so a task that runs again deals its
rows to the same parts.  Equal rows of a hot key are counted before they are
dealt (partially before the shuffle), and their copies are dealt in runs: a
key whose rows are all alike is split like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of the summary: shares above about 4 / TRACKED are never missed.
TRACKED = 1 << 16
#: Equal rows that go to one part together.
RUN = 1024


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None,
             tracked: int = TRACKED) -> DataFrame:
    """(__hot, __parts): the hash of every hot key and the parts it is dealt to (2 or more).

    A key is hot if it holds more than one ``parts``-th of the rows (by default
    the session's shuffle partitions).  At most ``tracked`` / 8 rows, so the
    result may be broadcast.  A cold key that shares a hot key's hash is split
    too, which changes no result.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, min(parts, tracked // 8))
    found = df.select(F.xxhash64(*keys).alias("__key")).agg(
        F.expr(f"approx_top_k(__key, {most}, {tracked})").alias("__top"), F.count(F.lit(1)).alias("__n"))
    share = F.ceil(F.col("__item.count") * F.lit(most) / F.col("__n")).cast("int")
    return (found.where("__n > 0").select(F.explode("__top").alias("__item"), "__n")
            .select(F.col("__item.item").alias("__hot"), share.alias("__parts")).where("__parts > 1"))


def _marked(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    return df.withColumn("__hot", F.xxhash64(*keys)).join(F.broadcast(hot), "__hot", "left")


def split_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """``df`` with ``__part``: 0 for rows of cold keys, one of the key's parts for rows of hot ones.

    Rows of hot keys are grouped by all their columns, which have to be of
    types that Spark can group (no maps).
    """
    columns = df.columns
    marked = _marked(df, keys, hot)
    cold = marked.where("__parts is null").select(*columns, F.lit(0).alias("__part"))
    counted = marked.where("__parts is not null").groupBy(*columns, "__parts").agg(
        F.count(F.lit(1)).alias("__copies"))
    runs = counted.withColumn("__run", F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / RUN))))
    part = F.pmod(F.xxhash64(*columns) + F.col("__run"), F.col("__parts")).cast("int")
    copies = F.least(F.col("__copies") - F.col("__run") * RUN, F.lit(RUN)).cast("int")
    spread = (runs.select(*columns, part.alias("__part"), F.array_repeat(F.lit(0), copies).alias("__each"))
              .select(*columns, "__part", F.explode("__each")).drop("col"))
    return cold.union(spread)


def copy_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """``df`` with ``__part``: rows of cold keys once, rows of hot keys once for every part."""
    every = F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)
    return _marked(df, keys, hot).select(*df.columns, F.explode(every).alias("__part"))
