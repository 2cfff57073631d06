"""Connected components of an edge table by alternating star contractions.

Every round is a pair of grouped minima and joins on the edge table; the
state between rounds is a checkpoint in the shared folder.  A hub with very
many edges is one key of a sort-merge join (split by AQE) and one key of a
partially aggregated minimum; no neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation; ``edges`` holds each edge once as (a > b)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else edges
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    # large: larger neighbours move to the centre's minimum; small: the others do
    moved = around.join(least, "a")
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                      F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one type that has an order).

    ``root`` is the smallest node of the component.  Loops and repeated edges
    are allowed; an empty table gives an empty table.
    """
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        state = cut(_star(_star(state, large=True), large=False))
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
