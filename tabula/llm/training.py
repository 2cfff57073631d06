"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(labels: DataFrame, label: str, rows: int, without_held_out: bool = False) -> DataFrame:
    """(labelled_id, label double) of at most ``rows`` labelled documents, lowest by hash first.

    A document labelled more than once counts once, with the larger label;
    rows without id or label do not count.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if without_held_out:
        known = known.where(~held_out(F.col("doc_id")))
    return (known.groupBy(F.col("doc_id").cast("bigint").alias("labelled_id"))
            .agg(F.max(label).cast("double").alias("label"))
            .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(rows))


def held_out(doc_id):
    """Rows kept from training: crc32 of the id as text leaves 2 divided by 4 (NULL: no)."""
    return F.coalesce(F.crc32(doc_id.cast("bigint").cast("string")) % 4 == 2, F.lit(False))
