import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabula.llm import importance as Q


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (9, 1, 0), (11, 0, 0), (None, 1, 0), (12, None, None), (9, 0, 1)],
                                 "doc_id bigint, quality int, toxic int")


def test_base_counts_equal_brute_force(edge_docs, edge_rows, labels):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in Q.judged(edge_docs, labels).collect()), key=repr)
    assert got == sorted(((r[0], *brute_base(r[1])) for r in edge_rows), key=repr)


def test_base_counts_of_lines_symbols_and_windows(spark, labels):
    texts = ["a\nb\na\n \n \n\nb ", "x y z x y z x y", "a b c a b\x0bc a b", "#*$%&|<>" * 9, "   ",
             "p q r s " * 20, "l1\r\nl1\nl1\r\n", "é" * 60, " lead and trail ", "w " * 49, "v%d " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in Q.judged(docs, labels).collect()}
    assert got == {k: brute_base(t) for k, t in enumerate(texts)}


def test_scores_are_the_mean_log_ratio(spark, edge_docs, edge_rows, labels):
    rows = edge_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    features = {(r.doc_id, r.text): r.features for r in
                rows.withColumn("features", Q.features(F.col("text"), 500)).collect()}
    for (_, text), own in features.items():
        tokens = re.findall(r"[^\W_]+|[^\w\s]+|_+", text)      # close enough to count them
        assert abs(len(own) - max(0, 2 * len(tokens) - 1)) <= 2
    weights = Q.bucket_weights(rows, labels, 500)
    raw, target = Counter(), Counter()
    for r in edge_rows:
        own = features[r[0], r[1] or ""]
        raw.update(own)
        if r[0] in (1, 9):
            target.update(own)
    n, m = sum(raw.values()), sum(target.values())
    want = [math.log((target[b] + 1) / (m + 500)) - math.log((raw[b] + 1) / (n + 500)) for b in range(500)]
    assert weights == pytest.approx(want)
    for r in rows.withColumn("score", Q.score(F.col("text"), weights)).collect():
        own = features[r.doc_id, r.text]
        assert r.score == pytest.approx(sum(want[b] for b in own) / len(own) if own else 0, abs=1e-5)


def test_verdict_and_kept_rows(edge_docs, edge_rows, labels):
    judged = Q.judged(edge_docs, labels).collect()
    assert all(r.kept == (not r.base_failed and r.score >= Q.THRESHOLD) for r in judged)
    kept = Q.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.kept for r in judged)


def test_without_labels_or_rows(spark, edge_docs, no_docs, labels):
    none = labels.limit(0)
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in Q.judged(edge_docs, none).collect())
    assert Q.judged(no_docs, labels).collect() == []


def test_junk_is_told_from_clean_text(spark):
    """Trained on some rows, the rules keep clean documents and reject junk among the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    rows = Q.judged(docs, seen).join(labels.where("doc_id % 2 = 1"), "doc_id").where("n_words >= 50").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(junk) <= 0.35 * len(junk)


def test_all_trusted_documents_count(spark):
    """More good labels than the 20,000 that once were the bound."""
    n = 20_500
    ids = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    labels = ids.select("doc_id", F.lit(1).alias("quality"))
    # every document is trusted: both multinomials are one and the same
    assert Q.bucket_weights(ids, labels, 50) == pytest.approx([0.0] * 50, abs=1e-12)
