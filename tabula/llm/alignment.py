"""Alignment of the tokens that two tokenizers make of one text.

Both tokenizers read a blank and the text; a token covers a range of those
bytes.  For every text the ends of both sides' tokens go into dictionaries
from end to index; the intersection of their keys, sorted, cuts both id lists
into groups, and each group gives the link between the two tokens that end
with it (no token is empty, so one of each side ends at a common end).

*Counts.*  How often an id pair is linked is a statistic of the whole corpus.
The pass over the texts writes each text's distinct pairs and how often it has
them; the pairs are summed up over all texts, and come back to the texts in
two ways that give all of them: the most frequent pairs, ``COMMON`` at most,
are a broadcast of known size, the others go through a shuffle by pair.  The
border lies at a power of two found from a histogram of the counts, so the
common pairs, which would be the hot keys of that shuffle, never enter it.

*Segments.*  No token of either side goes on from something other than white
space into a blank (the second side's vocabulary is searched for one), so both
have an end before every such blank, and what lies between two of them is
tokenized and aligned by itself.  A text is cut there into segments, mostly
words.  Each worker keeps what it found for ``STORED`` segments, and for as many
that it met before those, so common words are tokenized once; memory is bounded
by that store and the longest segment.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import cut, narrowed
from tabula.session import scratch_path

#: Characters of the texts that are taken together.
BATCH = 1 << 20
#: Segments in each of the two generations that a worker remembers, and the longest one worth it.
STORED = 1 << 17
SHORT = 64
#: The places between something other than white space and a blank that is not the last character.
SAFE = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
#: Pairs that are broadcast at most.
COMMON = 1 << 17
BLANK = "▁"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes.

    A visible character of Latin-1 stands for its own byte; the other bytes, in
    order, are the letters from U+0100 on.
    """
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_tokens(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary (token -> id)."""
    letters = byte_letters()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        out[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


def piece_tokens(pieces: list[str]) -> list[bytes]:
    """Bytes of every piece: U+2581 is a blank, <0xHH> the byte HH, others are UTF-8."""
    return [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and p.endswith(">")
            else p.replace(BLANK, " ").encode() for p in pieces]


class Sides:
    """The two tokenizers; one instance per Python worker.

    ``first`` is a byte-level tokenizer (JSON of the ``tokenizers`` library),
    ``second`` a sentencepiece model that puts a blank before a text.
    """

    def __init__(self, first: str, second: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(first)
        self.first.encode_special_tokens = True             # their strings are plain text
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.bytes_a = byte_level_tokens(self.first.get_vocab(with_added_tokens=True))
        self.bytes_b = piece_tokens(pieces)
        self.length_a = [len(t) for t in self.bytes_a]
        self.length_b = [len(t) for t in self.bytes_b]
        self.whole = any(BLANK in p.lstrip(BLANK) for p in pieces)  # a token may cross a cut

    def segments(self, text: str) -> list[str]:
        """A blank and ``text``, cut at the safe places; every segment begins with a blank."""
        return [" " + text] if self.whole else SAFE.split(" " + text)

    def ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for texts that begin with a blank."""
        a = self.first.encode_batch_fast(texts, add_special_tokens=False)
        b = self.second.encode([t[1:] for t in texts], num_threads=1)
        return [(x.ids, y) for x, y in zip(a, b)]

    def agree(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return (b"".join([self.bytes_a[k] for k in a]) == raw
                and b"".join([self.bytes_b[k] for k in b]) == raw)

    def slices(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        """(tokens of a, tokens of b) up to every common end, in order."""
        ends_a = {end: k for k, end in enumerate(accumulate([self.length_a[x] for x in a]), 1)}
        ends_b = {end: k for k, end in enumerate(accumulate([self.length_b[x] for x in b]), 1)}
        return [(ends_a[end], ends_b[end]) for end in sorted(ends_a.keys() & ends_b.keys())]


class _Aligned(NamedTuple):
    """What a segment's tokens come to: counts, groups as text, linked pairs in order (8 bytes each)."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes


class _Store:
    """Segments and their alignment; None where the two sides do not give the bytes back."""

    def __init__(self, sides: Sides, stored: int) -> None:
        self.sides, self.stored = sides, stored
        self.recent, self.earlier = {}, {}
        self.decimal = [str(k) for k in range(max(len(sides.bytes_a), len(sides.bytes_b)))]

    def aligned(self, segment: str, a: list[int], b: list[int]) -> _Aligned | None:
        if not self.sides.agree(segment, a, b):
            return None
        groups, pairs, decimal = [], [], self.decimal
        i = j = 0
        for to_i, to_j in self.sides.slices(a, b):
            last_a, last_b = a[to_i - 1], b[to_j - 1]
            if to_i - i == 1 and to_j - j == 1:
                groups.append(f"{last_a}|{last_b}")
            else:
                groups.append(",".join([decimal[k] for k in a[i:to_i]]) + "|"
                              + ",".join([decimal[k] for k in b[j:to_j]]))
            pairs.append(last_a << 32 | last_b)
            i, j = to_i, to_j
        return _Aligned(len(a), len(b), len(groups), ";".join(groups), array("q", pairs).tobytes())

    def of(self, segments: set[str]) -> dict[str, _Aligned | None]:
        """The alignments of these segments, the new ones tokenized together."""
        out = {s: self.recent[s] for s in segments if s in self.recent}
        again = {s: self.earlier[s] for s in segments if s not in out and s in self.earlier}
        new = [s for s in segments if s not in out and s not in again]
        found = {s: self.aligned(s, a, b) for s, (a, b) in zip(new, self.sides.ids(new))} if new else {}
        # what was met lately stays; a full generation takes the place of the one before
        self.recent |= again | {s: own for s, own in found.items() if len(s) <= SHORT}
        if len(self.recent) > self.stored:
            self.recent, self.earlier = {}, self.recent
        return out | again | found


def _row(segments: list[str], aligned: dict[str, _Aligned | None]) -> tuple:
    """A text's row but for its id; zeros if a segment has no tokens."""
    own = [aligned[s] for s in segments]
    if not own or None in own:
        return 0, 0, 0, "", [], []
    n_a, n_b, n_groups, groups, links = zip(*own)
    pairs, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
    return (sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(";".join(groups).encode()).hexdigest(),
            pairs, times)


ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
           "pairs array<bigint>, times array<bigint>")


def aligned(docs: DataFrame, first: str, second: bytes, doc_id: str = "doc_id",
            text: str = "text", stored: int = STORED) -> DataFrame:
    """One row per document: token and group counts, hash of the groups, distinct linked pairs.

    ``groups_sha256`` is of ``a1,a2|b1;a3|b2,b3`` (decimal ids in order).  A
    pair is the first side's id times 2^32 plus the second's; ``times`` is how
    often the document links it.  Texts that are NULL or empty, or whose bytes
    either side does not give back, have zeros, an empty hash and no pairs.
    One narrow pass; repeated rows give repeated results.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(first, second)
        store = _Store(sides, stored)

        def finished(ids: list, texts: list[str]) -> pa.RecordBatch:
            cut_up = [sides.segments(t) if t else [] for t in texts]
            found = store.of(set().union(*cut_up))
            columns = list(zip(*(_row(own, found) for own in cut_up)))
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
            for lists in columns[4:]:
                at = np.cumsum([0, *map(len, lists)])
                flat = np.concatenate([np.asarray(x, np.int64) for x in lists])
                arrays.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *arrays],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

        gc.disable()        # the store has no cycles, and walking it over and over costs a fifth of the time
        try:
            yield from results(batches, finished)
        finally:
            gc.enable()

    def results(batches: Iterator[pa.RecordBatch], finished) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(number)
                texts.append(value.as_py() or "")
                size += len(texts[-1])
                if size >= BATCH:
                    yield finished(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield finished(ids, texts)

    rows = narrowed(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) over rows (pair, times): all links of a pair; whether no pair of its second id has more."""
    counts = cut(links.groupBy("pair").agg(F.sum("times").alias("n")))
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("second")
    # one row per id of the second vocabulary: its size bounds this broadcast
    most = counts.groupBy(second).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", second).join(F.broadcast(most), "second").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def common_border(counts: DataFrame, common: int) -> int:
    """The least power of two that at most ``common`` pairs' counts reach."""
    sizes = counts.groupBy(F.floor(F.log2(F.col("n"))).cast("int").alias("power")).count().collect()
    border, reached = 63, 0
    for power, n in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):   # 63 rows at most
        reached += n
        if reached > common:
            break
        border = power
    return 1 << border if border < 63 else (1 << 63) - 1


def link_statistics(docs: DataFrame, first: str, second: bytes, doc_id: str = "doc_id",
                    text: str = "text", stored: int = STORED, common: int = COMMON) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``n_links`` counts the document's links, ``count_sum`` adds up the corpus-wide
    counts of their pairs, ``n_best`` counts links whose pair's count is the
    highest of its second id (ties included).  Rows and edge cases as in
    ``aligned``; rows without doc_id and rows that share one keep to themselves.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    # the place of a row names it; it is fixed once the table is written
    aligned(docs, first, second, doc_id, text, stored).withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    links = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    counts = cut(pair_counts(links.select("pair", "times")))
    border = common_border(counts, common)
    often, seldom = F.col("n") >= border, F.col("n") < border

    linked = links.join(F.broadcast(counts.where(often)), "pair", "left")
    sums = [F.sum(F.col("times") * F.col("n")).alias("count_sum"),
            F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best")]
    from_common = linked.where("n is not null").groupBy("row").agg(*sums)
    from_others = (linked.where("n is null").select("pair", "row", "times")
                   .join(counts.where(seldom), "pair").groupBy("row").agg(*sums))
    both = from_common.union(from_others).groupBy("row").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))

    def number(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    return (rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
            .join(both, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                    number("n_best"), number("count_sum"), "groups_sha256"))
