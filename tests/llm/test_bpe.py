import hashlib
import random

import public_tokenizers
import pytest

from tabula.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TOKENIZER = bpe.encoding(RANKS, public_tokenizers.PATTERN)


def test_equals_whole_text_encoding(edge_docs, edge_rows):
    got = sorted((tuple(r) for r in bpe.digests(edge_docs, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for doc_id, text, *_ in edge_rows:
        ids = TOKENIZER.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_round_trip_through_tables(edge_docs, edge_rows):
    tokens = bpe.encoded(edge_docs, RANKS, public_tokenizers.PATTERN)
    texts = [r.bytes.decode() for r in bpe.decoded(tokens, RANKS, public_tokenizers.PATTERN).collect()]
    assert sorted(texts) == sorted((r[1] or "") for r in edge_rows)


def test_empty_table(no_docs):
    assert bpe.digests(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_cuts_never_change_the_ids(seed, monkeypatch):
    rng = random.Random(seed)
    alphabet = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "a", "Zé", "'s", "'", "12", "!?", "文", "́", "<|endoftext|>"]
    text = "".join(rng.choice(alphabet) for _ in range(600))
    cut = list(bpe.parts(text, 16))
    assert "".join(cut) == text
    assert [i for p in cut for i in TOKENIZER.encode_ordinary(p)] == TOKENIZER.encode_ordinary(text)


def test_bytes_that_are_no_text():
    ids = [TOKENIZER.encode_single_token(bytes([b])) for b in (0xFF, 0xC3, 0x28)]
    assert TOKENIZER.decode_bytes(ids) == b"\xff\xc3\x28"
