import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.llm import spelling as S
from tabula.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(u, v):
    """Exactly one insertion, deletion or replacement, letter by letter."""
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    long, short = (u, v) if len(u) > len(v) else (v, u)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(rows, shortest=6, least=5, ratio=5, one_in=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    # every near word shares a pattern with one letter free or left out
    by = defaultdict(set)
    for w in counts:
        for k in range(len(w) + 1):
            by[w[:k] + "*" + w[k:]].add(w)
            if k < len(w):
                by[w[:k] + "*" + w[k + 1:]].add(w)
    around = defaultdict(set)
    for group in by.values():
        for u in group:
            around[u] |= {v for v in group if near(u, v)}
    form = {}
    for w, n in counts.items():
        best = min(around[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(around[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def planted():
    """Chains of forms, hubs, ties, accents, words at the least length, and long words."""
    rng = random.Random(3)
    words = {"common": 400, "commom": 60, "comom": 900, "commomx": 9, "commmomx": 5, "straße": 30, "strasse": 6,
             "strase": 6, "élèves": 50, "élèvez": 7, "eleves": 5, "éleves": 6, "x" * 30: 25, "x" * 29: 5,
             "x" * 31: 5, "abcdef": 10, "bcdefg": 10, "aabcdef": 50, "abcdeff": 50, "short": 99, "ÀÈÌÒÙÂ": 8,
             "àèìòùâ": 8, "hapaxes": 4, "tiecase": 5, "tiecasf": 25, "tiecasa": 25, "MiXedUp": 5, "mixedup": 5}
    for k in range(40):
        words["hubword" + "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìí"[k]] = 5 + k
    text = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(text)
    rows = [(k, " ".join(text[k::50]) + "×12÷" + "don't") for k in range(50)]
    return rows + [(60, None), (61, ""), (None, "common nulldoc " * 7), (62, "common " * 3), (62, "common " * 3)]


def test_equals_brute_force_on_planted_words(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id bigint, text string").withColumns(
        {c: F.lit("clash") for c in ("word", "run", "h", "n", "key", "near", "root", "form")})
    want = brute(planted)
    assert collected(S.variants(docs)) == want
    roots = {w: r for w, _, r, *_ in want}
    assert roots["commomx"] == "common" and len({f for _, f, *_ in want if f}) > 5


def test_other_parameters(spark, planted):
    docs = spark.createDataFrame(planted, "doc_id bigint, text string")
    assert collected(S.variants(docs, shortest=2, least=1, ratio=2, one_in=7)) == brute(planted, 2, 1, 2, 7)
    with pytest.raises(ValueError):
        S.variants(docs, ratio=1)


def test_edge_rows(spark, edge_docs, edge_rows):
    assert collected(S.variants(edge_docs, least=2)) == brute([r[:2] for r in edge_rows], least=2)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(QUERIES["op11_spelling_variants"](spark, SF)) == brute(rows)


@pytest.mark.parametrize("tile", [1, 5, 64])
def test_blocks_of_a_large_key(spark, tile):
    rng = random.Random(tile)
    words = sorted({"prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) + "suffix"
                    for _ in range(150)})
    pairs = S.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), tile).collect()
    want = sorted((u, v) for u in words for v in words if u < v and near(u, v))
    assert sorted(map(tuple, pairs)) == want and want


def test_tiles_equal_letterwise_comparison():
    rng = random.Random(11)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 7))) for _ in range(130)]
    got = S.single_edits(S.matrix(words[:70]), S.matrix(words[70:]))
    want = np.array([[near(u, v) for v in words[70:]] for u in words[:70]])
    assert (got == want).all()


def test_no_documents(spark, no_docs):
    assert S.variants(no_docs).collect() == []
    assert S.variants(spark.createDataFrame([(1, "too few words")], "doc_id bigint, text string")).collect() == []
