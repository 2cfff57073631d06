"""Quality classifier and toxicity chain: by their parts, and by held-out accuracy."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabula.llm import classifier_chain as C
from tabula.llm import rule_ensemble as R
from tabula.llm.training import held_out, labelled_sample

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, int(k % 3 != 0), int(k % 7 == 0)) for k in range(100, 130)]
    return spark.createDataFrame(rows + [(None, 1, 1), (1, None, None), (100, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")


def test_statistics_of_texts():
    of = dict(zip(R.STATISTICS, R.statistics("Aa BB 12!!\nAa BB 12!!\n| cc")))
    assert of["n_words"] == 8 and of["n_lines"] == 3 and of["upper_words"] == 2 / 8
    assert of["distinct_words"] == 5 / 8 and of["marked_words"] == 3 / 8
    assert of["repeated_windows"] == pytest.approx(1 - 5 / 6)
    empty = dict(zip(R.STATISTICS, R.statistics("")))
    assert all(x == 0 for name, x in empty.items() if name != "line_words")
    assert len(R.statistics("x" * 10_000_000)) == len(R.STATISTICS)


def test_rules_are_the_paths_of_the_trees():
    printed = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 1.0E-4)
      Predict: 0.0
     Else (feature 1 > 1.0E-4)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 0 <= 0.2)
      Predict: 0.0
     Else (feature 0 > 0.2)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    inf = float("inf")
    found = {r.bounds for r in R.rules_of(printed, ("a", "b"))}
    assert found == {(("a", -inf, 0.5),), (("a", -inf, 0.5), ("b", -inf, 1e-4)), (("a", -inf, 0.5), ("b", 1e-4, inf)),
                     (("a", 0.5, inf),), (("a", -inf, 0.2),), (("a", 0.2, 0.5),)}


def test_compiled_score_equals_the_model(spark):
    inf = float("inf")
    model = R.Ensemble(((R.Rule((("n_words", 2.0, 8.0),)), 1.5), (R.Rule((("upper", -inf, 0.1),)), -0.5)), 0.25)
    rows = spark.createDataFrame([(w, u) for w in (2.0, 2.5, 8.0, 9.0) for u in (0.1, 0.2)],
                                 "n_words double, upper double")
    import math
    for r in rows.withColumn("s", model.score()).collect():
        total = 0.25 + 1.5 * (2 < r.n_words <= 8) - 0.5 * (r.upper <= 0.1)
        assert r.s == pytest.approx(1 / (1 + math.exp(-total)))


def test_samples_are_bounded_and_leave_held_out_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = labelled_sample(rows, "quality", 100, without_held_out=True)
    assert sample.count() == 100 and sample.where(held_out(F.col("labelled_id"))).count() == 0


@pytest.mark.parametrize("scored", [R.scored, C.scored])
def test_edge_cases(scored, edge_docs, edge_rows, no_docs, labels):
    got = scored(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(r[0]) for r in edge_rows)
    assert scored(no_docs, labels).collect() == []
    assert scored(edge_docs, labels.limit(0)).count() == len(edge_rows)
    assert scored(edge_docs, labels.where("quality = 1 and toxic = 0")).count() == len(edge_rows)


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = R.scored(docs, labels).where("held_out").join(labels, "doc_id").collect()
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = sorted(r.score for r in rows if r.quality == 0)
    wins = sum(sum(g > b for b in bad) + 0.5 * sum(g == b for b in bad) for g in good)
    assert len(bad) > 50 and wins / (len(good) * len(bad)) > 0.97
    right = sum(r.predicted == r.quality for r in rows)
    assert right > 0.95 * len(rows)


def test_toxicity_on_documents_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = C.scored(docs, labels.where("doc_id % 3 > 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    # junk's toxic words were overwritten when it was made junk: told by clean text only
    toxic = [r for r in rows if r.toxic == 1 and r.quality == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert len(toxic) > 100
    assert sum(r.predicted for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_chain_feeds_earlier_probabilities():
    chain = C.Chain(("a", "b"), (-1.0, -2.0), ((), (4.0,)), {"x": (3.0, 0.5)})
    p, q = chain.probabilities(Counter({"x": 3, "y": 1}))
    import math
    n = math.log1p(3)
    assert p == pytest.approx(1 / (1 + math.exp(1 - 3 * n)))
    assert q == pytest.approx(1 / (1 + math.exp(-(-2.0 + 0.5 * n + 4 * p))))


def test_out_of_fold_probabilities_come_from_other_folds(spark):
    """A word found in one fold only cannot help that fold."""
    rng = random.Random(3)
    rows = []
    for k in range(300):
        toxic = k % 3 == 0
        own = ["idiot"] * toxic + [f"w{rng.randint(0, 5)}"]
        rows.append((k, float(toxic), own, [1] * len(own)))
    chain = C.fit(spark.createDataFrame(
        rows, "doc_id bigint, label double, words array<string>, counts array<int>"))
    assert chain.names == ("insult", "contempt", "toxic") and chain.words["idiot"][0] > 0
    assert [len(x) for x in chain.links] == [0, 1, 2]
    assert chain.probabilities(Counter(["idiot"]))[2] > 0.5 > chain.probabilities(Counter(["w1"]))[2]


def test_rare_toxic_words_are_terms(spark):
    """300 toxic words, each in a few texts: all of them are known, and told."""
    toxic = [f"t{k}" for k in range(300)]
    rows = [(k, 1.0, [toxic[k % 300], "the"], [1, 1]) for k in range(1800)]
    rows += [(2000 + k, 0.0, [f"c{k % 40}", "the"], [1, 1]) for k in range(1800)]
    chain = C.fit(spark.createDataFrame(
        rows, "doc_id bigint, label double, words array<string>, counts array<int>"))
    assert set(toxic) <= chain.words.keys()
    assert all(chain.probabilities(Counter([t, "the"]))[-1] > 0.5 for t in toxic)


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"word{k}" for k in range(5000)) + " scum"
    whole = C.terms(text)
    monkeypatch.setattr(C, "PART", 100)
    assert C.terms(text) == whole and whole["scum"] == 1 and whole["word1-"] == 1111 - 1


def test_drop_toxic_keeps_rows_and_columns(spark, edge_docs, edge_rows, labels):
    out = C.drop_toxic(edge_docs, labels)
    assert out.columns == edge_docs.columns
    kept = C.scored(edge_docs, labels).where("predicted = 0").count()
    assert out.count() == kept
