"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  Each
segment, read as a 23-bit word, is decoded with the perfect binary Golay
(23, 12, 7) code: every word lies within three bits of exactly one codeword.

*Fuzzy keys of a segment.*  A stored fingerprint has one index, that of its
nearest codeword.  A probing one has the indices of all codewords within four
bits: one if it lies within two bits of its codeword, six if it lies three
bits off.  Two segments that differ in at most one bit always share an index:
the stored word is within three bits of its codeword, so the probing word is
within four bits of it.

*Pigeonhole over three errors.*  Either some segment is free of errors, and
then one of the other two holds at most one (key: the exact segment with a
fuzzy index of another, six ordered pairs), or each segment holds exactly one
(key: the fuzzy indices of the first two with the error-free half of the
third).  Keys are 30 to 35 bits wide, so a bucket holds few strangers.

Probing and stored keys meet by a shuffle on the key.  In every task the
candidates of a bucket are compared in blocks and only the edges that join
two groups not yet joined in that task are passed on, so a bucket of g
fingerprints within reach of each other costs at most g - 1 rows, not its
pairs.  Groups are then the connected components of those edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tabula.llm.common import buffers, cut, narrowed, salted_hash
from tabula.llm.components import connected_components

#: Generator polynomial of the binary Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
SEED = 42
#: (first bit, width) of the three segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Largest number of differing bits that the keys are made for.
MAX_BITS = 3
#: Shingles hashed at a time, and candidate pairs compared at a time.
BLOCK = 1 << 16
PAIR_BLOCK = 1 << 20


# ------------------------------------------------------------ fingerprints

def simhash(text: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text, as a signed integer (see ``fingerprints``)."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        part = words[start:start + BLOCK + shingle - 1]
        runs = zip(*[part[k:] for k in range(shingle)]) if len(words) > shingle else [part]
        hashes = np.array([digest(b" ".join(run), seed) for run in runs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 3, seed: int = SEED) -> DataFrame:
    """(doc_id, fp bigint) of every row, whole texts, in one narrow pass.

    A-Z are lower-cased, words are runs free of ASCII white space, shingles
    are ``shingle`` consecutive words joined by one blank, repeats included
    (fewer words: the whole sequence).  A bit is set if it is set in over half
    of the shingles' XXH64.  NULL, empty and blank texts have fingerprint 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(batch.column(1))
            fps = [simhash(data[a:b].tobytes(), shingle, seed) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = narrowed(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


# ------------------------------------------------------------- Golay code

def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word; by syndrome, the
    error pattern and the index offsets of the codewords within four bits.

    The code is systematic: a codeword's index is its upper twelve bits.
    Offsets are -1 where a word has one codeword within four bits only.
    """
    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(w) for w in range(1 << 12)], np.int64)
    high = np.array([remainder(w << 12) for w in range(1 << 11)], np.int64)
    one = [1 << k for k in range(23)]
    errors = np.zeros(1 << 11, np.int64)
    for i in range(23):
        errors[remainder(one[i])] = one[i]
        for j in range(i):
            errors[remainder(one[i] | one[j])] = one[i] | one[j]
            for k in range(j):
                errors[remainder(one[i] | one[j] | one[k])] = one[i] | one[j] | one[k]
    codewords = [(d << 11) | remainder(d << 11) for d in range(1 << 12)]
    sevens = np.array([c for c in codewords if c.bit_count() == 7], np.int64)
    offsets = np.full((1 << 11, 6), -1, np.int64)
    offsets[:, 0] = 0
    for syndrome in range(1 << 11):
        e = int(errors[syndrome])
        if e.bit_count() == 3:
            offsets[syndrome, 1:] = sevens[(sevens & e) == e] >> 11
    return low, high, errors, offsets


class Golay:
    """Vectorised decoding; one instance per Python worker."""

    def __init__(self) -> None:
        self.low, self.high, self.errors, self.offsets = golay_tables()

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 0xFFF] ^ self.high[words >> 12]

    def nearest(self, words: np.ndarray) -> np.ndarray:
        """Index of the codeword within three bits of each word."""
        return (words ^ self.errors[self.syndrome(words)]) >> 11

    def within_four(self, words: np.ndarray) -> np.ndarray:
        """Indices of all codewords within four bits: n x 6, -1 where none."""
        offsets = self.offsets[self.syndrome(words)]
        return np.where(offsets < 0, -1, self.nearest(words)[:, None] ^ offsets)


def segment(fps: np.ndarray, k: int) -> np.ndarray:
    first, width = SEGMENTS[k]
    return ((fps.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)


def keys_of(code: Golay, fps: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(probing, fingerprints, keys) blocks: all stored and all probing keys."""
    parts = [segment(fps, k) for k in range(3)]
    index = [code.nearest(p) for p in parts]
    fuzzy = [code.within_four(p) for p in parts]
    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                base = (tag << 60) | (parts[i] << 12)
                yield False, fps, base | index[j]
                at, col = np.nonzero(fuzzy[j] >= 0)
                yield True, fps[at], base[at] | fuzzy[j][at, col]
                tag += 1
    for half, width in ((parts[2] & 0x7FF, 11), (parts[2] >> 11, 11)):
        yield False, fps, (tag << 60) | ((index[0] << 12 | index[1]) << width) | half
        both = np.where((fuzzy[0] >= 0)[:, :, None] & (fuzzy[1] >= 0)[:, None, :],
                        fuzzy[0][:, :, None] << 12 | fuzzy[1][:, None, :], -1).reshape(len(fps), 36)
        at, col = np.nonzero(both >= 0)
        yield True, fps[at], (tag << 60) | (both[at, col] << width) | half[at]
        tag += 1


# ------------------------------------------------------------------ links

class Forest:
    """Union-find over fingerprints; ``add`` keeps the edges that join two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for x, y in zip(a.tolist(), b.tolist()):
            u, v = self.root(x), self.root(y)
            if u != v:
                self.parent[max(u, v)] = min(u, v)
                out.append((x, y))
        return out


def close_pairs(stored: np.ndarray, stored_at: np.ndarray, stored_n: np.ndarray,
                probes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``bits``: probe k meets stored[stored_at[k] : +stored_n[k]], in blocks."""
    start = 0
    total = np.cumsum(stored_n)
    while start < len(probes):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + PAIR_BLOCK, "right")))
        if stop == start + 1:       # one probe against a bucket of any size
            spans = [(start, o, min(PAIR_BLOCK, stored_n[start] - o))
                     for o in range(0, int(stored_n[start]), PAIR_BLOCK)]
        else:
            spans = [(start, 0, None)]
        for first, offset, length in spans:
            n = stored_n[first:stop] if length is None else np.array([length])
            who = np.repeat(np.arange(first, stop), n)
            inside = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            a, b = probes[who], stored[stored_at[who] + offset + inside]
            diff = np.bitwise_count((a ^ b).view(np.uint64))
            hit = (diff > 0) & (diff <= bits)
            if hit.any():
                yield a[hit], b[hit]
        start = stop


def near_edges(fps: DataFrame, bits: int = MAX_BITS, salts: int = 4) -> DataFrame:
    """Edges (a, b) that span the groups of fingerprints ``bits`` or fewer bits apart.

    ``fps`` has one row per distinct fingerprint (column fp).  The edges have
    the same connected components as all links have.  Probing keys are spread
    over ``salts`` tasks a bucket; the few stored keys are repeated for each.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys find at most {MAX_BITS} differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            words = np.asarray(batch.column(0), dtype=np.int64)
            for lo in range(0, len(words), 4096):
                for probing, fp, key in keys_of(code, words[lo:lo + 4096]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(fp), pa.array(np.full(len(key), probing))],
                        ["key", "fp", "probing"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        key = fp = np.zeros(0, np.int64)
        probing = np.zeros(0, bool)

        def edges(upto: int) -> Iterator[pa.RecordBatch]:
            k, f, p = key[:upto], fp[:upto], probing[:upto]
            stored, probes = f[~p], f[p]
            stored_keys = k[~p]
            left = np.searchsorted(stored_keys, k[p], "left")
            count = np.searchsorted(stored_keys, k[p], "right") - left
            meets = count > 0
            for a, b in close_pairs(stored, left[meets], count[meets], probes[meets], bits):
                if out := forest.add(a, b):
                    x, y = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

        for batch in batches:       # sorted by key; the last key may go on in the next batch
            key = np.concatenate([key, np.asarray(batch.column(0), dtype=np.int64)])
            fp = np.concatenate([fp, np.asarray(batch.column(1), dtype=np.int64)])
            probing = np.concatenate([probing, batch.column(2).to_numpy(zero_copy_only=False)])
            if len(key) and len(key) >= BLOCK and key[0] != key[-1]:
                upto = int(np.searchsorted(key, key[-1], "left"))
                yield from edges(upto)
                key, fp, probing = key[upto:], fp[upto:], probing[upto:]
        yield from edges(len(key))

    # about a hundred keys come of every fingerprint: small partitions first
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = fps.select("fp").repartition(parts, "fp").mapInArrow(keyed, "key bigint, fp bigint, probing boolean")
    salt = F.when(F.col("probing"), F.array(salted_hash("fp", parts=salts))).otherwise(
        F.array(*[F.lit(s) for s in range(salts)]))
    dealt = (keys.withColumn("salt", F.explode(salt)).repartition("key", "salt")
             .select("key", "fp", "probing").sortWithinPartitions("key"))
    return dealt.mapInArrow(linked, "a bigint, b bigint")


def _labelled(docs: DataFrame, doc_id: str, text: str, shingle: int, bits: int) -> DataFrame:
    """(doc_id, fp, root struct<first_id, fp>) of every row with a doc_id.

    A fingerprint is named by its smallest doc_id and itself, so that two
    fingerprints of one doc_id stay apart; the root of a group is its smallest
    name, and the group's smallest doc_id is read from it without another join.
    """
    fps = cut(fingerprints(docs, doc_id, text, shingle)).where("doc_id is not null")
    named = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
                .select("fp", F.struct("first_id", "fp").alias("name")))
    edges = near_edges(named, bits)
    for end in ("a", "b"):
        side = named.select(F.col("fp").alias(end), F.col("name").alias(f"name_{end}"))
        edges = edges.join(side, end)
    groups = connected_components(edges.select(F.col("name_a").alias("a"), F.col("name_b").alias("b")))
    roots = named.join(groups.withColumnRenamed("node", "name"), "name", "left").select(
        "fp", F.coalesce("root", "name").alias("root"))
    return fps.join(roots, "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links of
    ``bits`` or fewer differing bits, the row's own included.  Rows of one
    doc_id are rows like any other.  A row without doc_id takes no part: its
    component_id is NULL.  An empty table gives an empty table.
    """
    known = _labelled(docs, doc_id, text, shingle, bits).select(
        "doc_id", "fp", F.col("root.first_id").alias("component_id"))
    unknown = fingerprints(docs.where(F.col(f"`{doc_id}`").isNull()), doc_id, text, shingle)
    return known.union(unknown.select("doc_id", "fp", F.lit(None).cast("bigint")))


def _with_fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` with the fingerprint of their column ``own`` in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(batch.column(batch.num_columns - 1))
            fps = [simhash(data[a:b].tobytes(), shingle) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps, pa.int64())],
                                             [*batch.schema.names[:-1], "fp"])

    schema = rows.drop("own").schema.add("fp", LongType())
    return rows.select(*[c for c in rows.columns if c != "own"], "own").mapInArrow(run, schema)


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle: int = 3, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns kept.

    The row with the smallest doc_id stays; of several rows with that doc_id
    the one whose fingerprint gives the group its name, and of those with that
    fingerprint the one whose text sorts first.  Groups that share a doc_id
    keep a row each.  Rows without doc_id all stay.
    """
    labelled = cut(_labelled(docs, doc_id, text, shingle, bits))
    # the group's name says which row stays: one (doc_id, fp) for each group
    own_name = (F.col("root.first_id") == F.col("doc_id")) & (F.col("root.fp") == F.col("fp"))
    marks = (labelled.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(own_name).alias("stays"))
             .where("stays").drop("stays"))
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"))
    kept = rows.join(marks.hint("shuffle_hash"), "doc_id")
    # a doc_id with several rows: their fingerprints tell them apart
    several = kept.where("rows > 1").select("row", "doc_id", F.col(f"row.`{text}`").alias("own"))
    order = Window.partitionBy("doc_id", "fp").orderBy(F.col(f"row.`{text}`").asc_nulls_first())
    first = (_with_fingerprints(several, shingle)
             .join(labelled.where(own_name).select("doc_id", "fp").distinct(), ["doc_id", "fp"])
             .withColumn("place", F.row_number().over(order)).where("place = 1"))
    return (kept.where("rows = 1").select("row.*")
            .union(first.select("row.*"))
            .union(rows.where("doc_id is null").select("row.*")))
