"""The recipe's classifiers on the LIBSVM sample files that ship with Spark."""

import os

import pytest
from pyspark.sql import functions as F

from tabula.operators import models as M
from tabula.sources import files as IO


def _sample(name):
    import pyspark
    path = os.path.join(os.path.dirname(pyspark.__file__), "data", "mllib", name)
    if not os.path.exists(path):
        pytest.skip(f"{name} is not installed")
    return path


@pytest.fixture(scope="module")
def binary(spark):
    return IO.read_libsvm(spark, _sample("sample_libsvm_data.txt")).cache()


@pytest.fixture(scope="module")
def multiclass(spark):
    return IO.read_libsvm(spark, _sample("sample_multiclass_classification_data.txt")).cache()


def _accuracy(pred):
    return pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_binomial_logistic_recipe(binary):
    model = M.fit_logistic(binary, "label ~ features")  # maxIter 10, regParam 0.3, elastic net 0.8
    coef = M.coefficients(model, binary)
    assert coef.count() == 693  # intercept + 692 features
    assert coef.where(F.col("estimate") != 0).count() < 693  # the L1 part zeroes features
    assert _accuracy(M.predict(model, binary)) > 0.9


def test_multinomial_logistic_recipe(multiclass):
    model = M.fit_logistic(multiclass, "label ~ features")  # family inferred: 3 classes
    coef = M.coefficients(model, multiclass)
    assert sorted(r["class"] for r in coef.select("class").distinct().collect()) == [0, 1, 2]
    assert coef.count() == 3 * 5
    assert _accuracy(M.predict(model, multiclass)) > 0.5


@pytest.mark.parametrize("kind,params", [("decision_tree", {}),
                                         ("random_forest", {"numTrees": 10, "seed": 1}),
                                         ("gbt", {"maxIter": 10, "seed": 1})])
def test_tree_classifiers_recipe(binary, kind, params):
    model = M.fit_tree(binary, "label ~ features", kind, **params)
    assert _accuracy(M.predict(model, binary)) > 0.95
    summary = M.tree_summary(model, binary)
    assert summary.count() == 692
    assert abs(sum(r.importance for r in summary.collect()) - 1.0) < 1e-6


@pytest.mark.parametrize("kind,params", [("decision_tree", {}), ("random_forest", {"numTrees": 3}),
                                         ("gbt", {"maxIter": 2})])
@pytest.mark.parametrize("parts", ["one", "uneven"])
def test_tree_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch, kind, params, parts):
    seen = []

    class Seen(M._TREES[kind]):
        def fit(self, dataset, params=None):
            seen.extend(r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect())
            return super().fit(dataset, params)

    monkeypatch.setitem(M._TREES, kind, Seen)
    monkeypatch.setattr(M, "TASK_BYTES", 1000 * 224, raising=False)  # at most 1,000 rows a task
    df = spark.range(0, 20_000, 1, 1).select((F.col("id") % 50).cast("double").alias("x"),
                                             (F.col("id") % 7).cast("double").alias("z"),
                                             (F.col("id") % 50 > 25).cast("double").alias("y"))
    if parts == "uneven":
        df = df.where("x < 49").union(df.where("x >= 49"))  # 19,600 and 400 rows
    model = M.fit_tree(df, "y ~ x + z", kind, maxBins=64, seed=1, **params)
    assert sum(seen) == 20_000 and max(seen) <= 1050
    assert _accuracy(M.predict(model, df).withColumn("label", F.col("y"))) == 1.0


def test_tree_tasks_that_are_small_enough_are_left_alone(spark):
    df = spark.range(0, 1000, 1, 3).toDF("x")
    assert M._even_tasks(df, 200) is df
    assert M._even_tasks(df.where("x < 0"), 200).count() == 0


def test_glm_per_family(spark):
    rows = [(float(x), float(2 + 0.5 * x + (x % 3)), "a" if x % 2 else "b") for x in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, g string")
    out = M.fit_per_family(df, "y ~ x + g", ["gaussian", "poisson"])
    fams = {r.family for r in out.collect()}
    assert fams == {"gaussian", "poisson"}
    assert out.where(F.col("std_error").isNull()).count() == 0
