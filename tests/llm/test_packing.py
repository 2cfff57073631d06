import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabula.llm import packing as P

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
    TOKENIZER = file.read()


def whole(text):
    tokenizer = Tokenizer.from_str(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(found, rows, window):
    """Every id in one piece, sequences gapless, checksums right; returns padding."""
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append(whole(text))
    sequences, lengths = defaultdict(list), Counter()
    for r in found:
        assert r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id, r.doc_tokens] += r.length
        assert any(zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                   and len(ids) == r.doc_tokens for ids in texts[r.doc_id])
    assert lengths == Counter({(d, len(i)): sum(len(x) for x in ids if len(x) == len(i))
                               for d, ids in texts.items() for i in ids})
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert set(sequences) == set(range(len(sequences)))
    return padding


@pytest.mark.parametrize("window", [2048, 256])
def test_edge_cases(edge_docs, edge_rows, window):
    found = P.packed(edge_docs, TOKENIZER, 1, window).collect()
    assert check(found, edge_rows, window) == 0


def test_pieces_of_one_document_meet(edge_docs, edge_rows):
    found = sorted((r.doc_id, r.start, r.length) for r in P.packed(edge_docs, TOKENIZER, 1).collect()
                   if r.doc_id == 9)
    assert all(a + n == b for (_, a, n), (_, b, _) in zip(found, found[1:]))


def test_lengths_that_never_fill_a_window(spark):
    rows = [(k, "a " * 99) for k in range(50)]      # 100 ids each, in windows of 256
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(P.packed(docs, TOKENIZER, 1, 256).collect(), rows, 256) == 0


def test_empty_table(no_docs):
    assert P.packed(no_docs, TOKENIZER, 1).collect() == []


def test_words_end_to_end_are_the_text(edge_rows):
    encode = P.WordEncoder(TOKENIZER, None)
    rng = random.Random(2)
    odd = ["a\x1cb", "x́ ́y", "Σ ΟΔΟΣ", "it's 'S <|endoftext|> 42", " a b\u0085c", "ﬁ Å Å", "\x00 ​"]
    odd += ["".join(rng.choice(" \n\t 　aZé'文1!́ΣİẞK") for _ in range(80)) for _ in range(100)]
    texts = [t or "" for _, t, *_ in edge_rows] + odd
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == whole(text)[:-1], repr(text[:80])


def test_plain_words_are_split_as_the_tokenizer_does():
    encode = P.WordEncoder(TOKENIZER, None)
    assert encode.plain
    rng = random.Random(7)
    letters = "".join(chr(c) for c in range(33, 256) if c < 127 or c >= 0xC0)
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        ids = np.frombuffer(encode.word(word), np.uint32).tolist()
        assert ids == whole(word)[:-1] if _ < 200 else True
        if P.PLAIN_WORD.fullmatch(word):
            assert encode.plain_pieces(word) == encode.exact_pieces(word), word


def brute_fill(counts, capacity):
    reach = {0}
    for length, n in counts.items():
        reach = {r + k * length for r in reach for k in range(n + 1) if r + k * length <= capacity}
    return max(reach)


@pytest.mark.parametrize("seed", range(20))
def test_fill_is_closest_to_capacity(seed):
    rng = random.Random(seed)
    counts = Counter({rng.randint(1, 60): rng.randint(1, 5) for _ in range(6)})
    capacity = rng.randint(1, 150)
    chosen = P.closest_fill(counts, capacity)
    assert all(chosen[x] <= counts[x] for x in chosen)
    assert sum(x * n for x, n in chosen.items()) == brute_fill(counts, capacity)


@pytest.mark.parametrize("lengths", [300, 2000])
def test_plan_uses_the_histogram_up(lengths):
    rng = random.Random(8)
    histogram = {n: rng.randint(1, 10_000) for n in rng.sample(range(1, 2048), lengths)} | {2048: 77}
    patterns = P.plan(histogram)
    used, slack = Counter(), 0
    for pattern, times in patterns:
        total = sum(x * n for x, n in pattern.items())
        assert total <= 2048
        slack += (2048 - total) * times
        for x, n in pattern.items():
            used[x] += n * times
    assert used == Counter(histogram) and len(patterns) <= lengths + 50
    print(lengths, len(patterns), slack / sum(x * n for x, n in histogram.items()),
          sum(t for p, t in patterns if sum(x * n for x, n in p.items()) < 2048) / sum(t for _, t in patterns))
    assert slack < 0.2 * sum(x * n for x, n in histogram.items())


def test_ranks_count_every_row_of_a_length_once(spark):
    rows = [(k % 40, k, 0, 7 if k % 3 else 9) for k in range(300)] + [(None, 5, 0, 7)] * 30
    table = spark.createDataFrame(rows, "doc_id bigint, digest bigint, start bigint, length bigint")
    histogram = Counter(r[3] for r in rows)
    found = P.ranked(table, histogram, rows=8).collect()
    for length, n in histogram.items():
        assert sorted(r.rank for r in found if r.length == length) == list(range(n))


def test_texts_of_plain_characters_take_the_short_way():
    encode = P.WordEncoder(TOKENIZER, None)
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\t\raZsétm19.'!<ÉßÿÀx") for _ in range(200)) for _ in range(200)]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == whole(text)[:-1], repr(text)
    assert encode.plain and encode.plain_ids and not encode.known
