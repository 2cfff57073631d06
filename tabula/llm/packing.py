"""Packing of tokenised documents into windows by minimum bin slack.

*Pieces.*  A document's ids (with an end id) are cut into full windows and one
remainder, so only remainders have to be matched up.

*Plan.*  What matters of the remainders is how many there are of each length,
at most ``window`` - 1 numbers however large the table.  On that histogram the
minimum-bin-slack rule fills one window at a time: it starts from the longest
length left and asks a subset-sum over the remaining multiset (a bit set of
reachable totals for each step of the dynamic programme, counts split into
powers of two) for the total closest to the capacity, and traces back how
often each length takes part.  The pattern found is repeated as often as the
counts allow, so a pattern ends at least one length and the plan has at most
about ``window`` patterns; its size does not depend on the number of documents.

*Assignment.*  Remainders of one length are interchangeable: each gets its
rank within the length (counts by salted groups, as many as the length's rows
need, then a running offset, so a length that many documents share is ranked in
many tasks), and the rank names
pattern, repetition and place by an equality join with the broadcast plan.

*Loose ends.*  The remainders of windows that no multiset fills are laid end to
end and cut at window bounds; what is left over at the very end is cut into
windows of powers of two, which need no padding.  Only pieces that a cut goes
through are encoded again, for their parts' checksums.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabula.llm.common import cut, narrowed

WINDOW = 2048
#: Words, and pieces of words, whose ids a worker remembers.
KNOWN_WORDS = 300_000
#: Words of ASCII and of the composed letters up to U+00FF: these are their own
#: composed form and have one lower-case letter each.
PLAIN_WORD = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Their pieces: contractions, letters, single digits, other marks.
PLAIN_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                         "|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff \t\n\r]+")
#: What a text of plain words does not hold.
OTHER_CHARACTER = re.compile("[^ \t\n\r!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
#: Words on which a tokenizer must agree with PLAIN_PIECE for it to be used.
PROBES = ("Word", "It's", "I'LL'd", "a1b22", "x***y!!", "\u00c9t\u00e9\u00df", "'re-<tag>", "%%%", "_a_", "caf\u00e9s.", "\u00ff\u00c0")


# -------------------------------------------------------------- tokenising

class Remembered(dict):
    """Values of a function by its argument, each computed when first asked for."""

    def __init__(self, compute: Callable[[str], bytes]) -> None:
        super().__init__()
        self.compute = compute

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self.compute(key)
        return value


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space.

    Such a tokenizer never joins across white space, so a text's ids are its
    words' ids end to end.  Each word goes through the tokenizer's own steps
    (normaliser, pre-splitting, model) when it is first met; texts of plain
    characters are split into pieces by one expression instead.  Words and
    pieces are remembered up to a bound, beyond which they are met anew.
    """

    def __init__(self, tokenizer: str, end: int | None) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = self.tokenizer.model
        self.end = b"" if end is None else array("I", [end]).tobytes()
        self.known = Remembered(self.word)
        self.pieces = Remembered(self.model_ids)
        self.plain_ids = Remembered(
            lambda piece: self.model_ids(piece if piece.isascii() else piece.translate(self.letters)))
        # letters beyond ASCII as the tokenizer's pre-splitting writes them
        self.letters = {ord(c): "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))
                        for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self.plain = all(self.plain_pieces(w) == self.exact_pieces(w) for w in PROBES)

    @staticmethod
    def plain_pieces(word: str) -> list[str]:
        return PLAIN_PIECE.findall(word.lower())

    def exact_pieces(self, word: str) -> list[str]:
        normal = self.tokenizer.normalizer.normalize_str(word)
        back = {written: chr(c) for c, written in self.letters.items()}
        out = []
        for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            for written, letter in back.items():
                piece = piece.replace(written, letter)
            out.append(piece)
        return out

    @staticmethod
    def split(text: str) -> list[str]:
        # str.split() also drops U+001C..U+001F, which are no white space to the tokenizer
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [w for w in re.split("[ \t\n\r]+", text) if w]
        return text.split()

    def model_ids(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def word(self, word: str) -> bytes:
        if self.plain:
            if PLAIN_WORD.fullmatch(word):
                return b"".join(map(self.plain_ids.__getitem__, self.plain_pieces(word)))
        normal = self.tokenizer.normalizer.normalize_str(word)
        return b"".join(self.pieces[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            # no piece spans white space, so plain texts are split into pieces at once
            if self.plain and not OTHER_CHARACTER.search(text):
                ids = b"".join(map(self.plain_ids.__getitem__, PLAIN_PIECE.findall(text.lower())))
            else:
                ids = b"".join(map(self.known.__getitem__, self.split(text)))
            for remembered in (self.known, self.plain_ids, self.pieces):
                if len(remembered) > KNOWN_WORDS:
                    remembered.clear()
            yield np.frombuffer(ids + self.end, np.uint32)


def pieces(docs: DataFrame, tokenizer: str, end: int | None, window: int = WINDOW,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, start, length, ids_crc32, doc_tokens): windows and remainders.

    ``digest`` (of the text) tells rows of one doc_id apart.  NULL is empty;
    a text without ids and without end id gives no piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer, end)
        names = ["doc_id", "digest", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            for k in range(0, len(batch), 128):
                own = batch.slice(k, 128)
                at, start, length, crc, tokens = [], [], [], [], []
                for row, ids in enumerate(encode([t or "" for t in own.column(2).to_pylist()])):
                    for s in range(0, len(ids), window):
                        piece = ids[s:s + window]
                        at.append(row)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
                        tokens.append(len(ids))
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).take(rows), own.column(1).take(rows)]
                    + [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)], names)

    rows = narrowed(docs, doc_id=doc_id, text=text)
    return rows.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("digest"),
                       "text").mapInArrow(
        run, "doc_id bigint, digest bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


# -------------------------------------------------------------------- plan

def closest_fill(counts: Counter, capacity: int) -> Counter:
    """The multiset of ``counts`` whose total is the largest up to ``capacity``.

    Subset-sum on bit sets: bit t of a set says that total t is reachable.
    Counts are split into 1, 2, 4, ... so a length costs log(count) steps; the
    sets before each step are kept and traced back to counts.
    """
    steps: list[tuple[int, int, int]] = []     # (length, times, set before the step)
    reach, full = 1, (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        times = 1
        while left > 0:
            times = min(times, left)
            left -= times
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & full
            times *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    chosen: Counter = Counter()
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += times
            total -= length * times
    return chosen


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Patterns and how often each is repeated; together they use the histogram up."""
    left = Counter({length: n for length, n in histogram.items() if n > 0})
    patterns = []
    while left:
        longest = max(left)
        rest = left.copy()
        rest[longest] -= 1
        rest += Counter()                       # drops zeros
        pattern = closest_fill(rest, window - longest) if longest < window else Counter()
        pattern[longest] += 1
        times = min(left[length] // n for length, n in pattern.items())
        patterns.append((dict(pattern), times))
        for length, n in pattern.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
    return patterns


def laid_out(patterns: list[tuple[dict[int, int], int]], window: int):
    """The plan as rows, and the numbers of full windows and of loose ids.

    Rows: (length, first rank, ranks, each, base, stride, begin, loose).  In a
    full window ``base`` is its first sequence and ``begin`` the offset; the
    remainders of all other windows are *loose* and laid end to end, ``base``
    and ``stride`` being places in that row of ids.
    """
    used: Counter = Counter()
    rows, windows, ids = [], 0, 0
    for pattern, times in patterns:
        total = sum(length * n for length, n in pattern.items())
        loose, begin = total < window, 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, used[length], n * times, n, ids if loose else windows,
                         total if loose else 1, begin, loose))
            used[length] += n * times
            begin += n * length
        if loose:
            ids += total * times
        else:
            windows += times
    return rows, windows, ids


# -------------------------------------------------------------- assignment

PLAN = ("length bigint, first bigint, ranks bigint, each bigint, base bigint, "
        "stride bigint, begin bigint, loose boolean")
#: Cut pieces that are broadcast to find their texts; more are joined by a shuffle.
CUT_ROWS = 100_000
#: Rows of one length that are ranked together.
RANKED_ROWS = 20_000


def ranked(table: DataFrame, histogram: dict[int, int], rows: int = RANKED_ROWS) -> DataFrame:
    """``table`` with each row's rank (from 0) among the rows of its length.

    ``histogram`` tells how many rows a length has; they are spread over as
    many groups as hold about ``rows`` each, however many that are.  Only the
    groups' counts meet to give every group its first rank; they are joined
    on the key by which the rows have been dealt.
    """
    parts = table.sparkSession.createDataFrame(
        [(length, -(-n // rows)) for length, n in histogram.items()], "length bigint, parts int")
    salted = table.join(F.broadcast(parts), "length").withColumn(    # bounded: one row per length
        "salt", F.pmod(F.xxhash64("doc_id", "digest", "start"), F.col("parts"))).drop("parts")
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select("length", "salt",
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("lead"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "digest", "start")
    return (salted.withColumn("place", F.row_number().over(order) - 1)
            .join(firsts, ["length", "salt"])
            .withColumn("rank", F.col("lead") + F.col("place")).drop("salt", "lead", "place"))


def packed(docs: DataFrame, tokenizer: str, end: int | None, window: int = WINDOW,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its place: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Windows hold at most ``window`` ids; every id of every row lies in exactly
    one piece.  ``ids_crc32`` is of the ids as little-endian unsigned 32-bit
    numbers.  NULL texts are empty (the end id alone), rows of one doc_id are
    documents of their own, an empty table gives an empty table.
    """
    table = cut(pieces(docs, tokenizer, end, window, doc_id, text))
    # at most ``window`` rows, whatever the table's size
    histogram = {r["length"]: r["n"] for r in
                 table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, windows, loose_ids = laid_out(plan(histogram, window), window)
    lookup = F.broadcast(docs.sparkSession.createDataFrame(rows, PLAN))
    placed = (ranked(table, histogram).join(lookup, "length")
              .where("rank >= first and rank < first + ranks")
              .withColumn("at", F.expr("base + ((rank - first) div each) * stride"))
              .withColumn("begin", F.expr("begin + ((rank - first) % each) * length")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    full = placed.where("not loose").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.col("at").alias("sequence_id"), F.col("begin").alias("offset"))
    if not loose_ids:
        return full
    # loose ids fill windows end to end; what is left over goes into powers of two
    tail = loose_ids - loose_ids % window
    bounds, rest = [tail], loose_ids % window
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    ends = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    loose = placed.where("loose").withColumn("at", F.expr("at + begin"))
    inner = F.array_sort(F.filter(
        F.array_union(F.array(F.expr(f"(at div {window} + 1) * {window}")), ends),
        lambda x: (x > F.col("at")) & (x < F.expr("at + length"))))
    edges = F.concat(F.array("at"), inner, F.array(F.expr("at + length")))
    parted = (loose.withColumn("edges", edges)
              .withColumn("part", F.explode(F.expr("sequence(0, size(edges) - 2)")))
              .withColumn("a", F.expr("edges[part]")).withColumn("b", F.expr("edges[part + 1]"))
              .withColumn("passed", F.filter(ends, lambda x: x <= F.col("a")))
              .withColumn("sequence_id", F.when(F.size("passed") == 0, F.expr(f"{windows} + a div {window}"))
                          .otherwise(F.lit(windows + tail // window) + F.size("passed") - 1))
              .withColumn("offset", F.when(F.size("passed") == 0, F.expr(f"a % {window}"))
                          .otherwise(F.col("a") - F.array_max("passed")))
              .select("doc_id", "digest", F.expr("start + a - at").alias("start"),
                      F.expr("b - a").alias("length"), "ids_crc32", "doc_tokens", "sequence_id",
                      "offset", (F.size("edges") > 2).alias("cut")))
    parted = cut(parted)
    again = _checksums(docs, parted.where("cut"), tokenizer, end, doc_id, text)
    return full.union(parted.where("not cut").select(*columns)).union(again.select(*columns))


def _checksums(docs: DataFrame, parts: DataFrame, tokenizer: str, end: int | None,
               doc_id: str, text: str) -> DataFrame:
    """``parts`` of cut pieces with their own checksums: their documents are encoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer, end)
        for batch in batches:
            for k in range(0, len(batch), 64):
                own = batch.slice(k, 64)
                ids = encode([t or "" for t in own.column(own.schema.get_field_index("text")).to_pylist()])
                spans = zip(own.column(own.schema.get_field_index("start")).to_pylist(),
                            own.column(own.schema.get_field_index("length")).to_pylist())
                crc = [zlib.crc32(i[a:a + n].astype("<u4").tobytes()) for i, (a, n) in zip(ids, spans)]
                yield pa.RecordBatch.from_arrays(
                    [own.column(j) for j in range(6)] + [pa.array(crc, pa.int64())],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"])

    key = F.coalesce("doc_id", F.lit(-2**63)).alias("id")
    wanted = parts.select(key, "digest").distinct()
    if wanted.count() <= CUT_ROWS:      # a few windows' documents; else both sides are shuffled
        wanted = F.broadcast(wanted)
    rows = narrowed(docs, doc_id=doc_id, text=text).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-2**63)).alias("id"),
        F.xxhash64("text").alias("digest"), "text")
    texts = rows.join(wanted, ["id", "digest"]).dropDuplicates(["id", "digest"])
    return parts.select(key, "*").join(texts, ["id", "digest"]).select(
        "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "text").mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
             "offset bigint, ids_crc32 bigint")
