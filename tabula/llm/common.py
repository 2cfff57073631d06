"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.session import checkpoint_dir

#: ASCII white space as the word contracts define it: blank and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return what was written.

    Used for small intermediate tables that several later plans read, so that
    a lost executor costs a re-read and never a re-run of the scan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator works with.

    Extra columns of the input, whatever they are called, never reach the
    operator's own plan: ``narrowed(docs, doc_id="id", text="body")``.
    """
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def utf8(batch: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; NULL is empty."""
    for value in batch.cast(pa.large_binary()):
        yield value.as_py() or b""


def buffers(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column end to end, and the offsets."""
    column = batch.cast(pa.large_string()).cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once.

    A column that lambda functions refer to again and again may be put into
    them by the optimiser (a filter that is pushed below the projection) and
    then be computed for every element; a lambda variable may not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def salted_hash(*columns: Column | str, parts: int) -> Column:
    """A number below ``parts`` that depends on the columns' values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")
