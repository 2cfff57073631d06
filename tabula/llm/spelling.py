"""Spelling variants: words one edit apart, grouped under the common form.

*Words* are counted over whole texts in one aggregate; what is left for the
pairs is the table of distinct words.

*Candidates.*  Two words, the longer of m letters, are one edit apart if their
common prefix and common suffix together reach m - 1.  So one of the two has
ceil((m - 1) / 2) letters or more.  Take that half away: the rests are one edit
apart too, and again share a prefix or a suffix of half their length.  A word
therefore goes under four keys for every m it can be part of (its own length
and one more): the first half with the next or the last quarter, and the last
half with the first quarter or the one before it.  Words that are near share
such a key, which fixes about three quarters of their letters.

*Tiles.*  The words of a key are compared in blocks: two padded matrices of
code points, all rows of one against all rows of the other, by the lengths of
common prefix and suffix.  Small keys share a tile, keys of up to ``TILE`` words
are compared in tiles of ``SIDE`` rows.  The words of a larger key are dealt to numbered blocks, and every pair of blocks
is a task of its own, so a key's memory and time in a task are bounded however
many words it has.

*Forms.*  A word's form is its most frequent near word, if that is ``RATIO``
times as frequent.  Counts grow along the way, so the way from word to root is
short; it is followed by pointer doubling.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut, narrowed

LETTERS = r"[A-Za-zÀ-ÿ]"
#: Shortest word, least occurrences, and how much more frequent a form is.
SHORTEST, LEAST, RATIO = 6, 5, 5
#: Words of a key that are compared as one block; rows of a tile's side.
TILE = 2048
SIDE = 64
#: A form occurs at least twice as often as its word and a bigint counts to 2 ** 63: no way is longer.
LONGEST_WAY = 63


# ------------------------------------------------------------------ words

def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shortest: int = SHORTEST, least: int = LEAST, one_in: int = 199) -> DataFrame:
    """(word, n) of all words of ``shortest`` or more letters that occur ``least`` times or more.

    A word is a maximal run of ``LETTERS`` with A-Z lower-cased.  Where
    ``one_in`` divides the crc32 of "<doc_id>:<word>", the letter at that crc32
    modulo the length is left out.  NULL texts have no words; a row without
    doc_id counts as one with an empty id; repeated rows count again.
    """
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    # a run that is too short stays too short: it need not be taken
    runs = narrowed(docs, doc_id=doc_id, text=text).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, lower)).otherwise(F.col("run"))
    hashed = runs.select(low.alias("run"), "doc_id").select(
        "run", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.col("h") % one_in == 0, F.concat(
        F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run"))
    )).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).where(F.length("word") >= shortest)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least))


# ------------------------------------------------------------- candidates

def _keys(word: Column, length: Column) -> Column:
    """The keys of a word: array<string>, four for every length m of the longer word."""
    out = []
    for more in (0, 1):
        m = length + more
        half = F.floor(m / 2).cast("int")                   # ceil((m - 1) / 2)
        quarter = F.floor((m - half) / 2).cast("int")       # the same of what the half leaves
        whole = half + quarter
        first, last = F.left(word, half), F.right(word, half)
        for kind, a, b in (("1", F.left(word, whole), F.lit("")), ("2", first, F.right(word, quarter)),
                           ("3", F.right(word, whole), F.lit("")), ("4", F.left(word, quarter), last)):
            out.append(F.concat(F.lit(kind), m.cast("string"), F.lit(":"), a, F.lit(" "), b))
    return F.array(*out)


def matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, padded: from the first letter on, from the last one back, lengths."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    width = int(lengths.max(initial=0)) + 1
    at = np.arange(width)
    start = np.cumsum(lengths) - lengths
    inside = at < lengths[:, None]
    ahead = np.zeros((len(words), width), np.uint32)
    back = np.zeros((len(words), width), np.uint32)
    ahead[inside] = points[(start[:, None] + at)[inside]]
    back[inside] = points[(start[:, None] + lengths[:, None] - 1 - at)[inside]]
    return ahead, back, lengths


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of ``a`` with every row of ``b``."""
    width = min(a.shape[1], b.shape[1])
    differ = a[:, None, :width] != b[None, :, :width]
    return np.where(differ.any(axis=2), differ.argmax(axis=2), width)


def single_edits(a: tuple, b: tuple) -> np.ndarray:
    """For every row of one matrix and every row of another: exactly one edit apart."""
    longer = np.maximum(a[2][:, None], b[2][None, :])
    shorter = np.minimum(a[2][:, None], b[2][None, :])
    # padding equals padding: beyond the shorter word nothing counts as common
    ahead = np.minimum(common(a[0], b[0]), shorter)
    back = np.minimum(common(a[1], b[1]), shorter)
    return (ahead + back >= longer - 1) & (longer - shorter <= 1) & (ahead < longer)


def _pairs_within(words: list[str], group: np.ndarray) -> list[tuple[str, str]]:
    """Near pairs among the words of each group; all groups are compared as one tile."""
    own = matrix(words)
    x, y = np.nonzero(np.triu(single_edits(own, own) & (group[:, None] == group), 1))
    return [(words[i], words[j]) for i, j in zip(x.tolist(), y.tolist())]


def _pairs_of(words: list[str], sides: np.ndarray) -> Iterator[tuple[str, str]]:
    """Near pairs of one key's words; a pair of blocks compares side 0 with side 1 only."""
    across = bool(sides.any())
    left = [w for w, s in zip(words, sides) if s == 0] if across else words
    right = [w for w, s in zip(words, sides) if s == 1] if across else words
    blocks = [(o, matrix(right[o:o + SIDE])) for o in range(0, len(right), SIDE)]
    for i in range(0, len(left), SIDE):
        own = matrix(left[i:i + SIDE])
        for j, other in blocks:
            if across or j >= i:
                x, y = np.nonzero(single_edits(own, other))
                for p, q in zip((x + i).tolist(), (y + j).tolist()):
                    if across or p < q:
                        yield left[p], right[q]


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b): the pairs a < b of distinct words (column word) that are one edit apart, each once."""
    keyed = words.select("word", F.explode(_keys(F.col("word"), F.length("word"))).alias("key"))
    blocks = F.ceil(F.col("n") / tile).cast("int")
    # keys of one word have no pairs; keys of more than a tile are cut into blocks
    wide = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", blocks.alias("blocks"))
    dealt = keyed.join(wide, "key")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    # block i meets every block j: as side 0 of (i, j) if i <= j, as side 1 of (j, i) otherwise
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi"),
        F.when(own <= j, 0).otherwise(1).alias("side")))
    rows = dealt.select("key", "word", F.inline(tiles))
    ordered = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, held, sides = None, [], []
        small, group = [], []           # whole keys that share a tile, and the key of each word

        def batch_of(pairs: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
            if pairs:
                a, b = zip(*[(min(p), max(p)) for p in pairs])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def tile_of_small() -> Iterator[pa.RecordBatch]:
            if small:
                yield from batch_of(_pairs_within(small, np.array(group)))
                small.clear()
                group.clear()

        def found() -> Iterator[pa.RecordBatch]:
            if len(held) > SIDE or any(sides):
                yield from batch_of(list(_pairs_of(held, np.array(sides))))
            elif len(held) > 1:
                if len(small) + len(held) > SIDE:
                    yield from tile_of_small()
                group.extend([len(small)] * len(held))
                small.extend(held)

        for batch in batches:
            for key, lo, hi, word, side in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (key, lo, hi) != mark:
                    yield from found()
                    mark, held, sides = (key, lo, hi), [], []
                held.append(word)
                sides.append(side)
        yield from found()
        yield from tile_of_small()

    return ordered.select("key", "lo", "hi", "word", "side").mapInArrow(compared, "a string, b string").distinct()


# ------------------------------------------------------------------ forms

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): forms followed to the last, by pointer doubling."""
    state = cut(forms.select("word", F.col("form").alias("root")))
    steps = 1
    while steps < LONGEST_WAY:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        state = cut(state.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if not state.where("moved").limit(1).count():
            break
        state, steps = state.drop("moved"), 2 * steps
    return state.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO,
             one_in: int = 199) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (see ``word_counts``).

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  ``form`` is the near word with the largest n (ties:
    the smallest in code-point order) if its n is ``ratio`` times the word's or
    more, else NULL; ``root`` follows forms to the last one (the word itself if
    it has none); ``n_near`` counts near words.  No documents, or none with
    words, give an empty table.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more: forms have to grow more frequent")
    words = cut(word_counts(docs, doc_id, text, shortest, least, one_in))
    pairs = near_pairs(words)
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    best = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
            .groupBy("word").agg(F.count("*").alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    judged = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n")))
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
