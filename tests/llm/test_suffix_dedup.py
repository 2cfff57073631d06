import hashlib
import random

import numpy as np
import pytest

from tabula.llm import suffix_dedup as S


def as_rows(df):
    return sorted((tuple(r) for r in S.digest_columns(S.repeats(df)).collect()), key=repr)


def expected(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    return sorted(((r[0], *x) for r, x in zip(rows, S.brute_force(texts))), key=repr)


def test_equals_brute_force_on_edge_cases(edge_docs, edge_rows):
    assert as_rows(edge_docs) == expected(edge_rows)


def test_empty_table(no_docs):
    assert as_rows(no_docs) == []
    assert S.remove_repeats(no_docs).columns == no_docs.columns


def test_overlaps_borders_and_periods(spark):
    rng = random.Random(3)
    filler = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = filler(260)
    rows = [(1, shared), (2, filler(50) + shared + filler(50)), (3, shared[60:] + filler(10)),
            (4, shared[:199] + filler(99)), (5, "ab" * 300), (6, "z" * 200), (7, "z" * 201),
            (8, shared[:230] + shared[30:]), (9, filler(400)), (10, shared[30:231] + "é")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert as_rows(docs) == expected([(a, b) for a, b in rows])


def test_many_documents_with_one_passage(spark):
    """A passage whose surroundings all differ: one anchor with hundreds of open runs."""
    rng = random.Random(4)
    filler = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = filler(320)
    rows = [(k, filler(rng.randint(0, 150)) + passage + filler(rng.randint(0, 150))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert as_rows(docs) == expected(rows)


def test_text_longer_than_a_chunk(spark, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, long), (2, long[3000:5000])]
    offsets = []
    for chunk in (1 << 21, 1000):
        monkeypatch.setattr(S, "CHUNK", chunk)
        import pyarrow as pa
        column = pa.array([t for _, t in rows])
        offsets.append(sorted((row, base + a) for r, b, data, at in S.pieces(column, 200)
                              for row, base, lo, hi in zip(r, b, at[:-1], at[1:])
                              for a in range(hi - lo - 199)))
    assert offsets[0] == offsets[1]     # every string once, however the text is cut


def test_family_levels_grow_geometrically():
    family, seen = S.Family(), {}
    rng = np.random.default_rng(1)
    for _ in range(40):
        batch = np.array([b"%016d" % x for x in rng.integers(0, 3000, rng.integers(1, 200))], "S16")
        for entry, cls in zip(batch.tolist(), family.add(batch).tolist()):
            assert seen.setdefault(entry, cls) == cls
        sizes = [len(level) for level, _ in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
        assert all((level[1:] > level[:-1]).all() for level, _ in family.levels)
    assert len(set(seen.values())) == len(seen) == family.classes


@pytest.mark.parametrize("width", [1, 7, 64, 200])
def test_rolling_hash_names_substrings(width):
    data = np.frombuffer((b"abcab" * 100)[:450], np.uint8)
    hashes = S.rolling(data, width)
    raw = data.tobytes()
    groups = {}
    for p, h in enumerate(hashes.tolist()):
        groups.setdefault(raw[p:p + width], set()).add(h)
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_removed_text_keeps_rows_and_columns(edge_docs, edge_rows):
    out = S.remove_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(edge_rows)
    kept = {(r.doc_id, hashlib.sha256(k).hexdigest()): k for r in S.repeats(edge_docs).collect() for k in [r.kept]}
    texts = {k.decode("utf-8", "ignore") for k in kept.values()}
    assert all(t is None or t in texts for t in (r.text for r in out.collect()))
