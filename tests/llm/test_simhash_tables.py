import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tabula.llm import simhash_tables as H


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_prints(spark, texts):
    """Fingerprints from the terms, counted in Python."""
    rows = spark.createDataFrame([(t,) for t in texts], "text string").withColumn(
        "terms", H.terms(F.col("text"))).collect()
    out = {}
    for r in rows:
        terms = [h & (1 << 64) - 1 for h in r.terms]
        fp = sum(1 << b for b in range(64) if terms and 2 * sum(h >> b & 1 for h in terms) > len(terms))
        out[r.text] = signed(fp)
    return out


def test_equals_brute_force_on_edge_cases(spark, edge_docs, edge_rows):
    got = H.with_edits(edge_docs, query_step=1).collect()
    assert len(got) == len(edge_rows)
    low = H.NO_ID
    ids = sorted({low if r[0] is None else r[0] for r in edge_rows})
    hashes = {r.text: r.h for r in spark.createDataFrame([(r[1] or "",) for r in edge_rows], "text string")
              .select("text", F.xxhash64("text").alias("h")).collect()}
    of = {i: min((r[1] or "" for r in edge_rows if (low if r[0] is None else r[0]) == i), key=hashes.get)
          for i in ids}
    edits = {}
    for doc_id, text, *_ in edge_rows:
        text, i = text or "", low if doc_id is None else doc_id
        following = of[ids[(ids.index(i) + 1) % len(ids)]]
        q = len(text) // 4
        edits[doc_id, text] = (text[:len(text) - q] + following[:q], following)
    prints = brute_prints(spark, {r[1] or "" for r in edge_rows} | {e for e, _ in edits.values()})
    want = []
    all_fps = [prints[r[1] or ""] for r in edge_rows]
    like = lambda a, b: 1 - ((a ^ b) & (1 << 64) - 1).bit_count() / 64
    for doc_id, text, *_ in edge_rows:
        text = text or ""
        edited, following = edits[doc_id, text]
        fp = prints[text]
        near = sum(((fp ^ g) & (1 << 64) - 1).bit_count() <= 3 for g in all_fps) - 1
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, prints[edited],
                     like(fp, prints[edited]), like(fp, prints[following]), None if doc_id is None else near))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(no_docs):
    assert H.with_edits(no_docs).collect() == []


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(7, "abcdefgh")], "doc_id bigint, text string")
    row = H.with_edits(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    stored = [rng.getrandbits(64) for _ in range(300)]
    queries = [x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, radius + 1))) for x in stored]
    frame = lambda xs: spark.createDataFrame([(signed(x),) for x in dict.fromkeys(xs)], "fp bigint")
    got = sorted((r["query"], r.fp, r.distance) for r in H.near(frame(queries), frame(stored), radius).collect())
    want = sorted((signed(q), signed(s), (q ^ s).bit_count()) for q in dict.fromkeys(queries)
                  for s in dict.fromkeys(stored) if (q ^ s).bit_count() <= radius)
    assert got == want


def test_neighbours_across_partitions(spark):
    rng = random.Random(1)
    ids = sorted(rng.sample(range(-10**15, 10**15), 500))
    rows = spark.createDataFrame([(i, 3, k) for k, i in enumerate(ids)], "id bigint, n_max bigint, digest bigint")
    got = {r.id: (r.next_id, r.prev_id) for r in H.in_order(rows.repartition(7)).collect()}
    assert got == {i: (ids[(k + 1) % 500], ids[k - 1]) for k, i in enumerate(ids)}


def test_main_path_has_no_python(spark, edge_docs):
    plan = H.with_edits(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
