import random

import numpy as np
import xxhash

from tabula.llm import golay_dedup as G
from tabula.llm.components import connected_components


def reference_fp(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    return sum(1 << b for b in range(64)
               if runs and 2 * sum(xxhash.xxh64_intdigest(r, 42) >> b & 1 for r in runs) > len(runs))


def brute_components(pairs, bits=3):
    """Smallest reachable doc_id of rows (doc_id, fp); rows without id take no part."""
    rows = [(i, f) for i, f in pairs if i is not None]
    label = {f: min(i for i, g in rows if g == f) for _, f in rows}
    changed = True
    while changed:
        changed = False
        for f in label:
            best = min(label[g] for g in label if (f ^ g).bit_count() <= bits)
            if best < label[f]:
                label[f], changed = best, True
    return label


def test_equals_brute_force_on_edge_cases(edge_docs, edge_rows):
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)
                  for r in G.near_duplicates(edge_docs).collect()), key=repr)
    prints = [(r[0], reference_fp(r[1])) for r in edge_rows]
    label = brute_components(prints)
    assert got == sorted(((i, f, None if i is None else label[f]) for i, f in prints), key=repr)


def test_one_row_of_each_group_stays(edge_docs, edge_rows):
    out = G.drop_near_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    # a group of fingerprints has one name: its smallest doc_id and that one's fingerprint
    groups = brute_groups([(r[0], reference_fp(r[1])) for r in edge_rows if r[0] is not None])
    got = [(r.doc_id, reference_fp(r.text)) for r in out.collect() if r.doc_id is not None]
    assert sorted(got) == sorted(min(g) for g in groups)
    assert out.where("doc_id is null").count() == sum(r[0] is None for r in edge_rows)


def brute_groups(prints):
    """The sets of (doc_id, fingerprint) that links of three bits or fewer connect."""
    groups = []
    for own in set(prints):
        near = [g for g in groups if any((own[1] ^ f).bit_count() <= 3 for _, f in g)]
        groups = [g for g in groups if g not in near] + [{own}.union(*near)]
    return groups


def test_groups_that_share_a_doc_id_keep_a_row_each(spark):
    a, b = " ".join(f"alpha{k}" for k in range(80)), " ".join(f"beta{k}" for k in range(80))
    for rows in ([(15, a), (15, b), (20, b), (21, a)], [(15, a), (15, b), (3, b), (21, a)], [(1, a), (1, a), (1, a)]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        kept = sorted(tuple(r) for r in G.drop_near_duplicates(docs).collect())
        want = {t: min(i for i, own in rows if own == t) for _, t in rows}
        assert kept == sorted((i, t) for t, i in want.items())


def test_empty_table(no_docs):
    assert G.near_duplicates(no_docs).collect() == []
    assert G.drop_near_duplicates(no_docs).columns == no_docs.columns


def test_every_word_lies_within_three_bits_of_one_codeword():
    code = G.Golay()
    words = np.random.default_rng(2).integers(0, 1 << 23, 5000)
    codewords = np.array([(d << 11) | int(code.low[(d << 11) & 0xFFF] ^ code.high[(d << 11) >> 12])
                          for d in range(1 << 12)])
    for word, index, near in zip(words[:200], code.nearest(words[:200]), code.within_four(words[:200])):
        far = np.bitwise_count(codewords ^ word)
        assert (far <= 3).sum() == 1 and far[index] <= 3
        assert sorted(near[near >= 0]) == sorted(np.flatnonzero(far <= 4))


def test_fingerprints_within_three_bits_share_a_key():
    rng, code = random.Random(1), G.Golay()
    a = [rng.getrandbits(64) for _ in range(2000)]
    b = [x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for x in a]

    def keys(values, probing):
        out = {}
        signed = np.array(values, np.uint64).view(np.int64)
        for p, fps, ks in G.keys_of(code, signed):
            if p == probing:
                for f, k in zip(fps.view(np.uint64).tolist(), ks.tolist()):
                    out.setdefault(f, set()).add(k)
        return out

    stored, probes = keys(a, False), keys(b, True)
    assert all(stored[x] & probes[y] for x, y in zip(a, b))


def test_large_group_of_near_fingerprints(spark):
    """A chain and a dense ball: links only through others, and many in one bucket."""
    rng = random.Random(9)
    centre = rng.getrandbits(63)
    ball = {centre ^ sum(1 << k for k in rng.sample(range(40), rng.randint(0, 2))) for _ in range(300)}
    chain = [rng.getrandbits(63)]
    for k in range(20):
        chain.append(chain[-1] ^ (0b111 << (3 * k)))
    lone = {rng.getrandbits(63) for _ in range(50)}
    fps = list(ball | set(chain) | lone)
    rng.shuffle(fps)
    edges = G.near_edges(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    groups = {}
    for r in connected_components(edges).collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == sorted([len(ball), len(set(chain))])
    assert edges.count() < 40 * len(fps)


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (300, 301), (301, 300)]
    found = {r.node: r.root for r in connected_components(
        spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert all(found[k] == 0 for k in range(51)) and all(found[100 + k] == 100 for k in range(30))
    assert found[301] == found[300] == 300
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
