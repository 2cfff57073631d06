"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed one- and two-token features, one of trusted
target text and one of the raw corpus, give every feature bucket a weight,
the logarithm of the ratio of its shares.  A document's score is the mean
weight of its features, so it does not depend on the length.  A document is
kept if it passes the base rules and its score reaches a fixed threshold;
the same input always gives the same verdict.

Everything is built-in expressions.  The corpus counts cover all documents in
one pass with map-side partial aggregation down to ``buckets`` rows; the
weights are a literal of that many numbers, so scoring is a narrow pass.
All documents labelled good are trusted text; their ids are joined by a plain
equality join on doc_id, so the trusted counts grow with the labels.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import let

#: Feature buckets: the size of both multinomials.
BUCKETS = 10_000
#: Added to every bucket's count.
SMOOTHING = 1.0
#: Lowest mean log ratio of a kept document.
THRESHOLD = -0.15
#: Runs of letters and digits, and runs of other marks.
TOKENS = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
#: Highest share of words in repeated three-word windows, in per cent.
REPEAT_PERCENT = 50


def features(text: Column, buckets: int) -> Column:
    """Buckets of the one- and two-token runs of a text, as an array."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    return let(F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0)), lambda tokens: F.concat(
        F.transform(tokens, lambda t: bucket(t)),
        F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                    lambda t, i: bucket(t, F.get(tokens, i + 1)))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of all documents labelled good, each once."""
    return labels.where("quality = 1 and doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("trusted_id")).distinct()


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                   smoothing: float = SMOOTHING) -> list[float]:
    """log(target share / raw share) of every bucket, over all documents (doc_id, text).

    ``buckets`` numbers come to the driver, however large the corpus.  Without
    trusted text all weights are 0.
    """
    # one kind of join at every size: the work grows in proportion to the input
    trusted = trusted_ids(labels).hint("merge")
    flagged = docs.join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
    counts = (flagged.select(F.col("trusted_id").isNotNull().cast("int").alias("is_target"),
                             F.explode(features(F.col("text"), buckets)).alias("bucket"))
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("is_target").alias("target")))
    found = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}
    raw_total = sum(raw for raw, _ in found.values())
    target_total = sum(target for _, target in found.values())
    if not target_total:
        return [0.0] * buckets
    out = []
    for b in range(buckets):
        raw, target = found.get(b, (0, 0))
        out.append(math.log((target + smoothing) / (target_total + smoothing * buckets))
                   - math.log((raw + smoothing) / (raw_total + smoothing * buckets)))
    return out


def score(text: Column, weights: list[float]) -> Column:
    """The mean weight of a text's features, 0 without any."""
    table = F.from_json(F.lit(json.dumps([round(w, 6) for w in weights])), "array<double>")
    return let(features(text, len(weights)), lambda found: F.when(F.size(found) > 0, F.aggregate(
        found, F.lit(0.0), lambda a, b: a + F.get(table, b)) / F.size(found)).otherwise(F.lit(0.0)))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that are found twice or more, the first included."""
    none = F.lit(0).cast("bigint")
    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(places: Column) -> Column:
        # a window covers three words, less what the one before it covers too
        return F.aggregate(F.transform(places, lambda p, k: F.least(
            F.lit(3), p - F.coalesce(F.get(places, k - 1), p - 3))), none, lambda a, x: a + x)

    def again(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["h"].eqNullSafe(x["h"])
                                                | F.get(ordered, k + 1)["h"].eqNullSafe(x["h"])))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def count(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), none).otherwise(let(ordered, again))

    return let(windows, count)


def base_counts(text: Column) -> Column:
    """The base rules' counts of a text, as one struct.

    Words are runs free of ASCII white space.  n_dup_lines counts the lines
    with a word that equal an earlier line; n_repeat_words the words in
    three-word windows that are found twice or more, the first included.
    """
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words, lambda ws: F.struct(
        F.size(ws).cast("bigint").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("bigint").alias("word_chars"),
        repeated_words(ws).alias("n_repeat_words")))
    repeats = let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint"))
    symbols = F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint")
    return let(of_words, lambda w: F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), symbols.alias("n_symbols"),
        repeats.alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
        ((w["n_words"] < MIN_WORDS) | (w["n_repeat_words"] * 100 > w["n_words"] * REPEAT_PERCENT))
        .alias("base_failed")))


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Every row's counts and verdict.

    Columns: row (struct of all input columns), doc_id, the base counts,
    base_failed, score and kept.  NULL texts are empty and fail the base
    rules; rows without doc_id are judged but never trusted; repeated rows get
    the same verdict; an empty table gives an empty table.
    """
    rows_ = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    weights = bucket_weights(rows_.select("doc_id", "text"), labels, buckets)
    scored = rows_.select("row", "doc_id", base_counts(F.col("text")).alias("base"),
                          score(F.col("text"), weights).alias("score"))
    return scored.select("row", "doc_id", "base.*", "score").withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that are not kept, all columns kept (see ``judged``)."""
    return judged(docs, labels, **options).where("kept").select("row.*")
