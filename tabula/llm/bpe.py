"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The rank file's path is a parameter; its bytes are shipped once to each Python
worker inside the function (they are bounded by the vocabulary).  Texts are
encoded by ``encode_ordinary``, so special tokens are ordinary text.

*Long texts.*  The pre-splitting pattern takes white space only at the start
of a match: no match goes on from another character into white space, and no
look-ahead of a match that ends there reads past it.  A text may therefore be
cut before any white space that follows something else, and the parts' ids,
end to end, are the whole text's.  Texts longer than ``PART`` characters are
cut at the last such place of every part, so the memory of the splitter does
not grow with the text.  A part without such a place grows until there is one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import narrowed

#: Characters of a text encoded at a time.
PART = 1 << 16
#: White space that follows something else: no match crosses the place before it.
SAFE = re.compile(r"(?<=\S)(?=\s)")


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file's content (lines of base64 token, rank)."""
    table = {}
    for line in ranks.splitlines():
        if line:
            token, rank = line.split()
            table[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """``text`` cut at safe boundaries into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        stop = start + size
        # the last boundary within the part, else the first one after it
        cut = next((p for p in range(stop, max(start, stop - 4096), -1)
                    if text[p].isspace() and not text[p - 1].isspace()), None)
        if cut is None:
            found = SAFE.search(text, stop)
            if found is None:
                break
            cut = found.start()
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode(tokenizer: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PART:
        return tokenizer.encode_ordinary(text)
    return [i for part in parts(text) for i in tokenizer.encode_ordinary(part)]


def encoded(docs: DataFrame, ranks: bytes, pattern: str, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row, whole texts; NULL and empty: no ids.

    One narrow pass; repeated rows give repeated results, an empty table an
    empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks, pattern)
        for batch in batches:
            for k in range(0, len(batch), 256):
                own = batch.slice(k, 256)
                ids = [encode(tokenizer, t or "") for t in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = narrowed(docs, doc_id=doc_id, text=text)
    return rows.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>")


def decoded(tokens: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, bytes binary) of rows (doc_id, ids): the raw bytes, valid UTF-8 or not.

    NULL or no ids: no bytes.  An id without a token raises.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks, pattern)
        for batch in batches:
            for k in range(0, len(batch), 256):
                own = batch.slice(k, 256)
                raw = [tokenizer.decode_bytes(ids or []) for ids in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def digests(docs: DataFrame, ranks: bytes, pattern: str, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row in one pass.

    Encodes each whole text, then decodes its ids; hashes are lower-case hex,
    of the decimal ids joined by commas and of the decoded bytes.  Rows as in
    ``encoded``; ids and bytes stay in the Python worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks, pattern)
        decimal = [b"%d" % i for i in range(tokenizer.max_token_value + 1)]
        for batch in batches:
            for k in range(0, len(batch), 1024):
                own = batch.slice(k, 1024)
                counts, id_hashes, byte_hashes = [], [], []
                for value in own.column(1):
                    total, first = 0, True
                    id_hash, byte_hash = hashlib.sha256(), hashlib.sha256()
                    for part in parts(value.as_py() or ""):
                        ids = tokenizer.encode_ordinary(part)
                        if ids:
                            if not first:
                                id_hash.update(b",")
                            first = False
                            id_hash.update(b",".join(map(decimal.__getitem__, ids)))
                            byte_hash.update(tokenizer.decode_bytes(ids))
                            total += len(ids)
                    counts.append(total)
                    id_hashes.append(id_hash.hexdigest())
                    byte_hashes.append(byte_hash.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes),
                     pa.array(byte_hashes)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = narrowed(docs, doc_id=doc_id, text=text)
    return rows.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
