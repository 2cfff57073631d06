"""Removal of long repeated byte strings by a family of suffix arrays.

*What is a repeat.*  A byte goes if it lies in a string of ``length`` bytes
that also starts anywhere else, in the same or in another document; strings
never cross documents, and all are judged on the input.

*Sparse suffixes.*  Every string of ``length`` bytes contains a least
``anchor``-byte substring (least by a hash, the leftmost of equals), which only
depends on the string.  Neighbouring strings share their anchor, so a document
falls into *runs* of strings with one anchor: about 1.7 runs per hundred bytes.
Only runs are shuffled, by their anchor's hash, and scanned in sorted order:

* a run whose whole text equals another's is repeated throughout;
* a run whose anchor occurs elsewhere, but in other surroundings, is open;
* all others hold no repeat and end there.

Equal runs of one scan task are collapsed before the shuffle, so a document
that makes up a third of the table sends one row a run and task.

*The index family.*  Open runs (and one representative of each repeated run
beside them) are cut into blocks of ``BLOCK`` starts, counted from the anchor,
and dealt by the bytes that all strings of a block share, which equal strings
must have in common.  In every shard the blocks arrive in batches.  A batch
gets its suffix array: its starts sorted by the ``length`` bytes that follow.
It is merge-scanned against the arrays of all levels for matches of ``length``
bytes or more, what is new becomes a level of its own, and levels merge while
one is not at least twice its successor, so a shard of m starts has O(log m)
levels and every start is merged O(log m) times.  An array's entries are the
first eight bytes and a digest of the string: sorting needs no text beyond its
own batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import buffers, narrowed

LENGTH = 200
ANCHOR = 64
#: Starts in a block; the bytes that a block's strings share are LENGTH - BLOCK + 1.
BLOCK = 32
#: Bytes of text handled at a time.
CHUNK = 1 << 21
#: Runs collapsed at a time before the shuffle.
COLLAPSE = 1 << 18
#: Fixed values of the rolling hash: one odd number a byte, and the multiplier.
BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
FACTOR = 0x9E3779B97F4A7C15
#: The id under which rows without doc_id are joined again (with their text's hash).
NO_ID = -2**63


# ------------------------------------------------------- strings as numbers

def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit polynomial hash of the ``width`` bytes from each position on."""
    power = lambda n: np.uint64(pow(FACTOR, n, 1 << 64))
    part, n, out, done = BYTES[data], 1, None, 0
    while True:
        if width & n:
            if out is None:
                out, done = part, n
            else:
                m = len(data) - (done + n) + 1
                out = out[:m] * power(n) + part[done:done + m]
                done += n
        if done == width:
            return out
        m = len(data) - 2 * n + 1
        part = part[:m] * power(n) + part[n:n + m]
        n *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, out = 1, values
    while 2 * n <= width:
        out = np.minimum(out[:len(out) - n], out[n:])
        n *= 2
    if n < width:
        m = len(values) - width + 1
        out = np.minimum(out[:m], out[width - n:width - n + m])
    return out


def runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """(piece, start, n, anchor, anchor's hash) of the runs of pieces laid end to end."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.view(np.uint64)
    hashes = rolling(data, anchor)
    # the upper 40 bits order the substrings, the place breaks ties to the left
    keyed = ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(24) << np.uint64(24)
             ) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(keyed, length - anchor + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    ends = np.zeros(len(at) + 1, np.int32)       # a string must end within its piece
    fits = sizes >= length
    np.add.at(ends, offsets[:-1][fits], 1)
    np.add.at(ends, (offsets[1:] - length + 1)[fits], -1)
    inside = np.cumsum(ends[:-1]) > 0
    piece = np.repeat(np.arange(len(sizes)), sizes)[:len(at)]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])
    start = np.flatnonzero(new & inside)
    stop = np.append(np.flatnonzero(new | ~inside), len(at))
    end = stop[np.searchsorted(stop, start, "right")]
    return piece[start], start, end - start, at[start], hashes[at[start]]


def pieces(column: pa.Array, length: int) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts in groups of about CHUNK bytes: rows, places in their texts, bytes, offsets.

    A longer text is cut into pieces that overlap by ``length`` - 1 bytes, so
    that every string lies in exactly one piece.
    """
    data, at = buffers(column)
    rows, bases, parts, size = [], [], [], 0

    def group():
        sizes = np.array([len(p) for p in parts], np.int64)
        return rows, bases, np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if b - a < length:
            continue
        for p in range(a, b - length + 1, CHUNK):
            part = data[p:min(b, p + CHUNK + length - 1)]
            if size and size + len(part) > CHUNK:
                yield group()
                rows, bases, parts, size = [], [], [], 0
            rows.append(row)
            bases.append(p - a)
            parts.append(part)
            size += len(part)
    if parts:
        yield group()


def place(start, before, n):
    """Start, distance to the anchor and number of strings of a run in one number."""
    return (start << 24) | (before << 12) | n


def unplace(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return places >> 24, (places >> 12) & 0xFFF, places & 0xFFF


# -------------------------------------------------------------- sparse runs

def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, digest, doc_id, text): id and digest name a row; equal rows share them."""
    rows = narrowed(docs, doc_id=doc_id, text=text)
    return rows.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64("text").alias("digest"), F.col("doc_id").cast("bigint"),
                       F.coalesce("text", F.lit("")).alias("text"))


def sparse_runs(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """One row per run: hash of its anchor and of its text, its document and place.

    ``known``: 0, a run; 1, it stands for several equal runs of its scan task;
    2, one of the others, already known to be repeated.
    """
    columns = ["anchor", "body", "id", "digest", "place", "known"]

    def collapsed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        hashes, bodies, ids, digests, places = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((bodies, hashes))
        h, b = hashes[order], bodies[order]
        first = np.ones(len(order), bool)
        first[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        several = np.diff(np.append(np.flatnonzero(first), len(order))) > 1
        known = np.full(len(order), 2, np.int8)
        known[order[first]] = several
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (hashes.view(np.int64), bodies.view(np.int64), ids, digests,
                                   places, known)], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids = np.asarray(batch.column(0), dtype=np.int64)
            digests = np.asarray(batch.column(1), dtype=np.int64)
            for rows, bases, data, offsets in pieces(batch.column(2), length):
                piece, start, n, at, hashes = runs(data, offsets, length, anchor)
                raw = data.tobytes()
                bodies = np.array([digest(raw[a:b]) for a, b in
                                   zip(start.tolist(), (start + n + length - 1).tolist())], np.uint64)
                row = np.array(rows)[piece]
                own = start - offsets[piece] + np.array(bases)[piece]
                held.append([hashes, bodies, ids[row], digests[row], place(own, at - start, n)])
                count += len(start)
                if count >= COLLAPSE:
                    yield collapsed(held)
                    held, count = [], 0
        if count:
            yield collapsed(held)

    return texts.select("id", "digest", "text").mapInArrow(
        run, "anchor bigint, body bigint, id bigint, digest bigint, place bigint, known tinyint")


def scanned(entries: DataFrame) -> DataFrame:
    """Runs that are repeated or open: (id, digest, place, repeated, open).

    Runs are dealt by their anchor's hash and sorted; each is compared with
    its neighbours only, so a run or an anchor that is very frequent streams
    through.  Runs that are known to be repeated are dealt by their document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = None, None       # anchor of the last class; rows of a class that may go on

        def classified(part: pa.RecordBatch, after) -> pa.RecordBatch:
            h, b = (np.asarray(part.column(k), dtype=np.int64) for k in (0, 1))
            known = np.asarray(part.column(5))
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(first)
            size = np.diff(np.append(at, len(h)))
            heads = h[at]
            shared = np.zeros(len(at), bool)
            shared[1:] |= heads[1:] == heads[:-1]
            shared[:-1] |= heads[1:] == heads[:-1]
            shared[0] |= before is not None and heads[0] == before
            shared[-1] |= after is not None and heads[-1] == after
            many = (size > 1) | (np.maximum.reduceat(known, at) > 0)
            cls = np.cumsum(first) - 1
            repeated = many[cls]
            is_open = shared[cls] & first       # one of each class takes part in the family
            keep = repeated | is_open
            return pa.RecordBatch.from_arrays(
                [part.column(k).filter(pa.array(keep)) for k in (2, 3, 4)]
                + [pa.array(repeated[keep]), pa.array(is_open[keep])],
                ["id", "digest", "place", "repeated", "open"])

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not len(batch):
                continue
            h, b = (np.asarray(batch.column(k), dtype=np.int64) for k in (0, 1))
            ends = np.flatnonzero((h[1:] != h[:-1]) | (b[1:] != b[:-1])) + 1
            if len(ends):
                done = int(ends[-1])
                yield classified(batch.slice(0, done), h[done])
                before, held = h[done - 1], batch.slice(done)
            else:
                held = batch
        if held is not None and len(held):
            yield classified(held, None)

    dealt = (entries.withColumn("part", F.when(F.col("known") < 2, F.col("anchor"))
                                .otherwise(F.xxhash64("id", "place")))
             .repartition("part").drop("part"))
    streamed = dealt.sortWithinPartitions(F.col("known") == 2, "anchor", "body")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[pa.RecordBatch] = []

        def unknown() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = int(np.searchsorted(np.asarray(batch.column(5)) == 2, True))
                if n:
                    yield batch.slice(0, n)
                if n < len(batch):
                    known.append(batch.slice(n))
                    return

        def rest() -> Iterator[pa.RecordBatch]:
            yield from known
            yield from batches

        yield from run(unknown())
        for batch in rest():
            yes, no = pa.array([True] * len(batch)), pa.array([False] * len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in (2, 3, 4)] + [yes, no],
                ["id", "digest", "place", "repeated", "open"])

    return streamed.mapInArrow(
        both, "id bigint, digest bigint, place bigint, repeated boolean, open boolean")


# --------------------------------------------------------- the index family

class Family:
    """Suffix arrays of geometrically growing sizes over the strings seen so far.

    A level is a sorted array of entries with the class of each; equal strings
    have one class.  ``add`` returns the classes of a batch's strings.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.classes = 0

    def add(self, entries: np.ndarray) -> np.ndarray:
        array, classes = np.unique(entries, return_inverse=True)   # the batch's suffix array
        found = np.full(len(array), -1, np.int64)
        for level, known in self.levels:                           # merge-scan
            at = np.searchsorted(level, array)
            at[at == len(level)] = 0
            same = level[at] == array
            found[same] = known[at[same]]
        new = found < 0
        found[new] = self.classes + np.arange(new.sum())
        self.classes += int(new.sum())
        if new.any():
            self.levels.append((array[new], found[new]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, ids = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(both, kind="stable")                # two sorted runs: a merge
            self.levels.append((both[order], ids[order]))
        return found[classes]


def suffix_entries(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Sortable entries of the strings at ``starts``: eight bytes and a digest."""
    head = np.lib.stride_tricks.sliding_window_view(data, 8)[starts]
    tail = rolling(data, length)[starts].astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([head, tail], axis=1).copy().view("S16").ravel()


def blocks(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """The open runs' blocks: shard key, bytes, document, place and weight."""
    spans = (found.where("open").select("id", "digest", "place", "repeated")
             .groupBy("id", "digest")
             .agg(F.collect_list(F.struct("place", "repeated")).alias("runs")))
    joined = texts.join(spans.hint("shuffle_hash"), ["id", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, at = buffers(batch.column(3))
            out: list[tuple] = []
            size = 0
            for k, own in enumerate(batch.column(4)):
                raw = data[at[k]:at[k + 1]].tobytes()
                for item in own.as_py():
                    where = item["place"]
                    start, before, n = where >> 24, (where >> 12) & 0xFFF, where & 0xFFF
                    anchor = start + before
                    s = start
                    while s < start + n:
                        # blocks are counted from the anchor, back to front
                        first = anchor - ((anchor - s) // BLOCK) * BLOCK - BLOCK + 1
                        stop = min(start + n, first + BLOCK)
                        core = raw[first + BLOCK - 1:first + length]
                        key = digest(core)
                        out.append((key - (1 << 64) if key >> 63 else key, raw[s:stop + length - 1],
                                    ids[k], digests[k], s, 2 if item["repeated"] else 1))
                        size += stop - s + length
                        s = stop
                    if size > 1 << 23:
                        yield _block_batch(out)
                        out, size = [], 0
            if out:
                yield _block_batch(out)

    # the same columns as in the last join, so that the texts are shuffled once for both
    return joined.select("id", "digest", "doc_id", "text", "runs").mapInArrow(
        run, "shard bigint, bytes binary, id bigint, digest bigint, start bigint, weight int")


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
        ["shard", "bytes", "id", "digest", "start", "weight"])


def matched(blocked: DataFrame, length: int) -> DataFrame:
    """(id, digest, start, n): runs of repeated strings among the blocks, by the family."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        held: list[tuple] = []      # classes, block of each string, ids, digests, starts, weights
        for batch in batches:
            data, at = buffers_of_binary(batch.column(1))
            n = np.diff(at) - length + 1
            block = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
            classes = family.add(suffix_entries(data, at[:-1][block] + inside, length))
            held.append((classes, n, *(np.asarray(batch.column(k), dtype=np.int64)
                                       for k in (2, 3, 4, 5))))
        if not held:
            return
        weights = np.zeros(family.classes, np.int64)
        for classes, n, *_, weight in held:
            np.add.at(weights, classes, np.repeat(weight, n))
        for classes, n, ids, digests, starts, _ in held:
            block = np.repeat(np.arange(len(n)), n)
            own = starts[block] + np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
            hit = np.flatnonzero(weights[classes] > 1)
            if not len(hit):
                continue
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) > 1) | (block[hit[1:]] != block[hit[:-1]])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(hit)))
            which = block[hit[first]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids[which], digests[which], own[hit[first]], count)],
                ["id", "digest", "start", "n"])

    return blocked.repartition("shard").mapInArrow(
        run, "id bigint, digest bigint, start bigint, n bigint")


def buffers_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[at[0]:at[-1]], at - at[0]


# ------------------------------------------------------------------ results

def repeated_strings(texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(id, digest, start, n): every start of a repeated string, as runs of starts."""
    found = scanned(sparse_runs(texts, length, anchor))
    whole = found.where("repeated").select(
        "id", "digest", F.shiftright("place", 24).alias("start"),
        F.col("place").bitwiseAND(0xFFF).alias("n"))
    return whole.union(matched(blocks(texts, found, length), length))


def starts_by_row(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(id, digest, starts): a list per row, which its own text's length bounds."""
    return (repeated_strings(texts, length, anchor).groupBy("id", "digest")
            .agg(F.collect_list(F.struct("start", "n")).alias("starts")))


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for span in spans for edge in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def spans_of(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans (from, to) covered by runs of starts."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(starts):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], start + n - 1 + length))
        else:
            out.append((start, start + n - 1 + length))
    return out


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(id, digest, doc_id, text, starts) of every row of ``docs``."""
    texts = keyed_texts(docs, doc_id, text)
    starts = starts_by_row(texts, length, anchor)
    return texts.join(starts.hint("shuffle_hash"), ["id", "digest"], "left")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_bytes, spans, kept binary) of every row of ``docs``.

    ``spans`` lists the removed bytes' maximal runs (from, to) in order,
    ``kept`` is what remains.  NULL and empty texts have no bytes; texts
    shorter than ``length`` keep all.  Rows that occur twice are repeats of
    each other.  An empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                data, at = buffers(part.column(1))
                sizes, spans, kept = [], [], []
                for j, own in enumerate(part.column(2).to_pylist()):
                    raw = data[at[j]:at[j + 1]].tobytes()
                    cuts = spans_of([(x["start"], x["n"]) for x in own or []], length)
                    sizes.append(len(raw))
                    spans.append([{"from": a, "to": b} for a, b in cuts])
                    kept.append(cut_out(raw, cuts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                     pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return with_spans(docs, doc_id, text, length, anchor).select("doc_id", "text", "starts").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, spans array<struct<from: bigint, to: bigint>>, kept binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` with every repeated byte cut out of ``text``, all columns kept.

    A cut may leave the first or last bytes of a character; what no longer
    reads as UTF-8 goes with it.  NULL stays NULL; no row is dropped.
    """
    @F.pandas_udf("string")
    def cleaned(texts, starts):
        out = []
        for value, own in zip(texts, starts):
            if value is None or own is None or not len(own):
                out.append(value)
                continue
            cuts = spans_of([(int(x["start"]), int(x["n"])) for x in own], length)
            out.append(cut_out(value.encode(), cuts).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    starts = starts_by_row(keyed_texts(docs, doc_id, text), length, anchor)
    value = F.col(f"row.`{text}`")
    rows = docs.select(F.struct("*").alias("row"),
                       F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(F.col(f"`{text}`")).alias("digest"))
    done = rows.join(starts.hint("shuffle_hash"), ["id", "digest"], "left").withColumn(
        "clean", F.when(F.col("starts").isNull(), value).otherwise(cleaned(value, F.col("starts"))))
    return done.select(*[F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`")
                         for c in docs.columns])


def digest_columns(rows: DataFrame) -> DataFrame:
    """Per row of ``repeats``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
                       F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by looking at every string; for tests."""
    seen: dict[bytes, int] = {}
    for raw in texts:
        for p in range(len(raw) - length + 1):
            seen[raw[p:p + length]] = seen.get(raw[p:p + length], 0) + 1
    out = []
    for raw in texts:
        gone = [False] * len(raw)
        upto = 0
        for p in range(len(raw) - length + 1):
            if seen[raw[p:p + length]] > 1:
                for q in range(max(p, upto), p + length):
                    gone[q] = True
                upto = p + length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
