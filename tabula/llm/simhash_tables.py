"""Document fingerprints: SimHash and permuted block tables.

Every pair of neighbouring words is a term; its 64-bit hash votes for each bit
by its sign, once for each time it occurs, so a term's weight is its frequency.  A
fingerprint's bit is the sign of the votes.  The votes of two bits share one
64-bit sum (32 bits each), so a fingerprint is 32 sums and a count.

*Block tables.*  A fingerprint is cut into six blocks.  Two fingerprints at
most three bits apart agree in at least three whole blocks, so with one table
for each choice of three blocks, those in front and used as key, they meet in
some table; a pair is reported by the first table it meets in.

Built-in expressions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.common import cut, let, narrowed

BITS = 64
RADIUS = 3
SPACE = r"[\x20\x09-\x0D]+"
#: Stands for a missing doc_id; sorts before all others.
NO_ID = -2**63


def terms(text: Column) -> Column:
    """Hashes of a text's neighbouring words, as an array.

    A single word is a term of its own; no words, no terms.
    """
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return let(words, lambda ws: F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(1))),
                                             lambda w, i: F.xxhash64(w, F.get(ws, i + 1))))


def votes_to_fingerprint(sums: list[Column], n: Column) -> Column:
    """Bit j of the result is set if more than half of ``n`` terms have it set."""
    low = [F.when(s.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > n, F.lit(1 << j)).otherwise(F.lit(0))
           for j, s in enumerate(sums)]
    high = [F.when(F.shiftrightunsigned(s, 32) * 2 > n, F.lit(_signed(1 << (j + 32)))).otherwise(F.lit(0))
            for j, s in enumerate(sums)]
    out = F.lit(0).cast("bigint")
    for bit in [*low, *high]:
        out = out.bitwiseOR(bit.cast("bigint"))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprinted(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., fp) of rows (keys..., text): one fingerprint for each key.

    Rows that share their keys must share their text.  Partitioning by the
    keys is kept: if the input has it, nothing is shuffled.
    """
    found = texts.select(*keys, F.explode_outer(terms(F.col("text"))).alias("h"))
    lanes = F.lit((1 << 32) | 1)
    sums = [F.sum(F.coalesce(F.shiftrightunsigned("h", j).bitwiseAND(lanes), F.lit(0).cast("bigint")))
            .alias(f"v{j}") for j in range(32)]
    votes = found.groupBy(*keys).agg(*sums, F.count("h").alias("n"))
    return votes.select(*keys, votes_to_fingerprint([F.col(f"v{j}") for j in range(32)],
                                                    F.col("n")).alias("fp"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for complements."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------ block tables

def table_masks(radius: int) -> list[int]:
    """One mask for each table: ``radius`` of 2 x ``radius`` blocks are in front."""
    blocks, masks, first = 2 * radius, [], 0
    for k in range(blocks):
        width = BITS // blocks + (k < BITS % blocks)
        masks.append(((1 << width) - 1) << first)
        first += width
    return [sum(masks[k] for k in chosen) for chosen in combinations(range(blocks), radius)]


def near(queries: DataFrame, stored: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fp, distance): all stored fingerprints within ``radius`` of a query's.

    Both inputs have one row per distinct fingerprint (column fp).  Each pair
    comes once; equal fingerprints are a pair at distance 0.
    """
    masks = [_signed(m) for m in table_masks(radius)]

    def tabled(rows: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("front"))
                         for k, m in enumerate(masks)])
        return rows.select(F.col("fp").alias(name), F.explode(keys).alias("k")).select(
            name, F.col("k.t").alias("t"), F.col("k.front").alias("front"))

    first = F.coalesce(*[F.when(F.col("query").bitwiseXOR(F.col("fp")).bitwiseAND(F.lit(m)) == 0, F.lit(k))
                         for k, m in enumerate(masks)])
    a, b = tabled(queries, "query").alias("a"), tabled(stored, "fp").alias("b")
    met = a.join(b, (F.col("a.front") == F.col("b.front")) & (F.col("a.t") == F.col("b.t"))
                 & (distance(F.col("query"), F.col("fp")) <= radius) & (first == F.col("a.t")))
    return met.select("query", "fp", distance(F.col("query"), F.col("fp")).alias("distance"))


# ------------------------------------------------- neighbours in id order

def in_order(ids: DataFrame) -> DataFrame:
    """Rows (id, n_max, digest), one an id, with next_id and prev_id, prev_n, around the end.

    Ids are range partitioned; neighbours are found within a partition, and
    across partitions from one first and one last row of each.
    """
    dealt = cut(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("part").orderBy("id")
    linked = (dealt.withColumn("next_id", F.lead("id").over(here))
              .withColumn("prev_id", F.lag("id").over(here))
              .withColumn("prev_n", F.lag("n_max").over(here)))
    ends = dealt.groupBy("part").agg(F.min("id").alias("first_id"), F.max(F.struct("id", "n_max")).alias("last"))
    parts = Window.orderBy("part")       # one row a partition
    around = (ends.withColumn("after", F.coalesce(F.lead("first_id").over(parts), F.min("first_id").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
              .withColumn("before", F.coalesce(F.lag("last").over(parts), F.max("last").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))))
    return (linked.join(F.broadcast(around.select("part", "after", "before")), "part")
            .select("id", "n_max", "digest", F.coalesce("next_id", "after").alias("next_id"),
                    F.coalesce("prev_id", F.col("before.id")).alias("prev_id"),
                    F.coalesce("prev_n", F.col("before.n_max")).alias("prev_n")))


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               radius: int = RADIUS, query_step: int = 100) -> DataFrame:
    """Every row's fingerprint, and how like it an edited text and the next document are.

    The edited text has its last floor(n_chars / 4) code points replaced by
    the first as many (or all) of the next document, in ascending doc_id,
    after the last the first.  Columns: doc_id, n_chars, edited_sha256, fp,
    edited_fp, near_edited, near_next, and n_near: for rows whose doc_id is
    divisible by ``query_step``, the number of other rows within ``radius``
    bits, found by the block tables over all fingerprints.

    NULL texts are empty.  Rows without doc_id come before all others; of
    several rows with one doc_id, that with the least hash of its text is the
    "next document" of those before.  An empty table gives an empty table.
    """
    base = narrowed(docs, doc_id=doc_id, text=text).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"))
    digest = F.xxhash64("text").alias("digest")
    ids = base.groupBy("id").agg(F.min(F.xxhash64("text")).alias("digest"),
                                 F.max(F.length("text")).cast("bigint").alias("n_max"))
    order = cut(in_order(ids))

    # one shuffle of the texts, by id, for both uses
    placed = base.join(order.withColumnRenamed("digest", "first_digest").hint("shuffle_hash"), "id")
    # a condition on the texts would become a join key, and the texts be shuffled by it again
    head = F.when(F.xxhash64("text") == F.col("first_digest"),
                  F.expr("substring(text, 1, cast(prev_n div 4 as int))"))
    heads = (placed.select(F.col("prev_id").alias("id"), head.alias("head"))
             .groupBy("id").agg(F.min("head").alias("head")))
    edited = placed.join(heads, "id").select(
        "id", digest, "text", "next_id", F.length("text").cast("bigint").alias("n_chars"),
        F.expr("concat(substring(text, 1, length(text) - cast(length(text) div 4 as int)), "
               "substring(head, 1, cast(length(text) div 4 as int)))").alias("edited"))
    both = edited.select("id", "digest", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), "text"),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("t")).select(
        "id", "digest", "t.which", "t.text")
    prints = fingerprinted(both, ["id", "digest", "which"]).groupBy("id", "digest").agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    facts = edited.select("id", "digest", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    known = cut(facts.join(prints, ["id", "digest"]))

    following = (known.join(order.select("id", "digest"), ["id", "digest"], "left_semi")
                 .groupBy(F.col("id").alias("next_id")).agg(F.min("fp").alias("next_fp")))
    shown = F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")
    out = (known.join(following, "next_id")
           .withColumn("near_edited", likeness(F.col("fp"), F.col("edited_fp")))
           .withColumn("near_next", likeness(F.col("fp"), F.col("next_fp"))))
    counts = known.groupBy("fp").agg(F.count("*").alias("rows"))
    asked = known.where((F.col("id") != NO_ID) & (F.col("id") % query_step == 0)).select("fp").distinct()
    found = (near(asked, counts.select("fp"), radius).join(counts, "fp")
             .groupBy(F.col("query").alias("fp")).agg((F.sum("rows") - 1).alias("n_near")))
    return (out.join(found, "fp", "left")
            .select(shown, "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next",
                    F.when((F.col("id") != NO_ID) & (F.col("id") % query_step == 0),
                           F.col("n_near")).alias("n_near")))
