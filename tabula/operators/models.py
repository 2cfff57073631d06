"""Formula-based models (MLR1-MLR11) on ``pyspark.ml``.

Every fit is a distributed job (``treeAggregate`` per optimiser iteration or
per tree level); the fitted model is small and lives on the driver.
Summaries are returned as DataFrames built from the model parameters
(bounded by features × classes), predictions as lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import IndexToString, RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.groups import distributed_rank


def _free_name(df: DataFrame, base: str) -> str:
    name, i = base, 0
    while name in df.columns:
        i += 1
        name = f"{base}_{i}"
    return name


def _formula(df: DataFrame, formula: str, handle_invalid: str = "error") -> RFormula:
    """MLR1: R formula → a feature vector + a label (text columns one-hot).

    The output columns are ``features`` / ``label`` unless the table already
    has columns of those names (a LIBSVM table has both, and the recipe fits
    ``label ~ features`` on it): then fresh names are used.
    """
    return RFormula(formula=formula, featuresCol=_free_name(df, "features"),
                    labelCol=_free_name(df, "label"), handleInvalid=handle_invalid)


def _pipeline(df: DataFrame, formula: str, estimator) -> PipelineModel:
    rf = _formula(df, formula)
    estimator.setFeaturesCol(rf.getFeaturesCol()).setLabelCol(rf.getLabelCol())
    return Pipeline(stages=[rf, estimator]).fit(df)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the formula's feature slots (from the column metadata)."""
    rf = model.stages[0]
    meta = rf.transform(df.limit(0)).schema[rf.getOrDefault("featuresCol")].metadata
    attrs = meta.get("ml_attr", {}).get("attrs", {})
    slots = []
    for group in attrs.values():
        slots.extend(group)
    slots.sort(key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def fit_logistic(df: DataFrame, formula: str, max_iter: int = 10, reg_param: float = 0.3,
                 elastic_net: float = 0.8, family: str = "auto",
                 standardization: bool = True) -> PipelineModel:
    """MLR2/MLR3: (multinomial) logistic regression with elastic-net penalty.

    ``family="auto"`` picks binomial for two classes and multinomial otherwise,
    as the recipe relies on.
    """
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param,
                            elasticNetParam=elastic_net, family=family,
                            standardization=standardization)
    return _pipeline(df, formula, lr)


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """MLR4: long coefficient table ``(class, feature, estimate)``.

    Binomial models have one class row set (class 1); the intercept is the
    feature ``(Intercept)``.
    """
    lr = model.stages[-1]
    names = feature_names(model, df)
    spark = df.sparkSession
    matrix = lr.coefficientMatrix.toArray()
    intercepts = lr.interceptVector.toArray()
    binomial = matrix.shape[0] == 1
    rows = []
    for k in range(matrix.shape[0]):
        cls = 1 if binomial else k
        rows.append((cls, "(Intercept)", float(intercepts[k])))
        for j, name in enumerate(names):
            rows.append((cls, name, float(matrix[k, j])))
    schema = T.StructType([T.StructField("class", T.IntegerType()),
                           T.StructField("feature", T.StringType()),
                           T.StructField("estimate", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """MLR5: predictions (lazy) with ``prediction`` and, for classifiers, ``probability``."""
    return model.transform(df)


_TREES = {
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
}


#: Bytes of training rows that one task of a tree learner holds and reads, and
#: bytes of a row's objects without its bins (224 measured for boosting on two features).
TASK_BYTES = 128 * 1024**2
ROW_BYTES = 216


def _even_tasks(df: DataFrame, row_bytes: int) -> DataFrame:
    """The rows, dealt out evenly if a partition has more than ``TASK_BYTES`` of them.

    The tree learners keep the training rows as objects in the partitions they
    come in and read them again for every level of every tree.  A scan's
    partitions follow the bytes of its files, and a few bytes there may be a
    row; so the rows of each partition are counted first (no column is read).
    """
    per_task = max(1, TASK_BYTES // row_bytes)
    rows, most = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    if not rows or most <= per_task:
        return df
    return df.repartition(max(-(-rows // per_task), df.sparkSession.sparkContext.defaultParallelism))


def fit_tree(df: DataFrame, formula: str, kind: str = "decision_tree", **params) -> PipelineModel:
    """MLR6-MLR8: decision tree, random forest (``numTrees``) or boosted trees (``maxIter``).

    Every row is used; a task holds at most ``TASK_BYTES`` of them.
    """
    if kind not in _TREES:
        raise ValueError(f"kind must be one of {list(_TREES)}")
    rf = _formula(df, formula)
    prepared = Pipeline(stages=[rf]).fit(df)
    tree = _TREES[kind](**params).setFeaturesCol(rf.getFeaturesCol()).setLabelCol(rf.getLabelCol())
    # a bin per feature and, in a forest, a count per tree
    row_bytes = ROW_BYTES + 4 * (len(feature_names(prepared, df)) + (tree.getNumTrees() if kind == "random_forest" else 0))
    # dealt out before the formula, whose vectors are wider than the columns they are made of
    return PipelineModel([*prepared.stages, tree.fit(prepared.transform(_even_tasks(df, row_bytes)))])


def tree_summary(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Tree summary as a table ``(feature, importance, num_trees, depth)``."""
    tree = model.stages[-1]
    names = feature_names(model, df)
    imp = tree.featureImportances.toArray()
    n_trees = getattr(tree, "getNumTrees", 1)
    depth = max(t.depth for t in tree.trees) if hasattr(tree, "trees") else tree.depth
    rows = [(n, float(imp[i]), int(n_trees), int(depth)) for i, n in enumerate(names)]
    schema = "feature string, importance double, num_trees int, depth int"
    return df.sparkSession.createDataFrame(rows, schema)


def fit_glm(df: DataFrame, formula: str, family: str = "gaussian", link: str | None = None,
            max_iter: int = 25, reg_param: float = 0.0) -> PipelineModel:
    """MLR9: generalized linear model (IRLS) for a family."""
    params = dict(family=family, maxIter=max_iter, regParam=reg_param)
    if link:
        params["link"] = link
    return _pipeline(df, formula, GeneralizedLinearRegression(**params))


def glm_coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """MLR9: ``(feature, estimate)`` of a fitted GLM, intercept last — no
    further job (the training summary needs extra passes over the data)."""
    glm = model.stages[-1]
    names = feature_names(model, df) + ["(Intercept)"]
    coefs = list(glm.coefficients.toArray()) + [glm.intercept]
    return df.sparkSession.createDataFrame(
        [(f, float(c)) for f, c in zip(names, coefs)], "feature string, estimate double")


_GLM_ROW = ("family string, feature string, estimate double, std_error double, t_value double, "
            "p_value double, deviance double, null_deviance double, aic double")


def _glm_rows(glm, names: list[str], family: str) -> list[tuple]:
    s = glm.summary
    coefs = list(glm.coefficients.toArray()) + [glm.intercept]
    try:
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
    except Exception:  # solver without standard errors
        se = tv = pv = [None] * len(coefs)
    return [(family, f, float(c), _f(e), _f(t), _f(p), float(s.deviance), float(s.nullDeviance),
             _f(s.aic)) for f, c, e, t, p in zip(names + ["(Intercept)"], coefs, se, tv, pv)]


def glm_summary(model: PipelineModel, df: DataFrame, family: str | None = None) -> DataFrame:
    """MLR9 summary: ``(family, feature, estimate, std_error, t_value, p_value,
    deviance, null_deviance, aic)`` — one row per coefficient."""
    glm = model.stages[-1]
    rows = _glm_rows(glm, feature_names(model, df), family or glm.getFamily())
    return df.sparkSession.createDataFrame(rows, _GLM_ROW)


def _f(v):
    return None if v is None else float(v)


def fit_per_family(df: DataFrame, formula: str, families: Sequence[str]) -> DataFrame:
    """MLR9/UDF5: one GLM per family, each fit distributed; summaries stacked.

    The recipe ships the fits to one task each; fitting a model on a large
    table is itself a distributed job, so the loop runs on the driver and each
    iteration uses the whole cluster.
    """
    rf = _formula(df, formula)
    prepared = Pipeline(stages=[rf]).fit(df)
    names = feature_names(prepared, df)
    # the features are made once for all families and iterations, and released
    data = prepared.transform(df).select(rf.getFeaturesCol(), rf.getLabelCol()).persist()
    try:
        rows = []
        for family in families:
            glm = GeneralizedLinearRegression(family=family, maxIter=25, featuresCol=rf.getFeaturesCol(),
                                              labelCol=rf.getLabelCol()).fit(data)
            rows += _glm_rows(glm, names, family)
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, _GLM_ROW)


def label_table(df: DataFrame, col: str, output: str = "label_index") -> DataFrame:
    """MLR11: ``(label, count, index)`` of a text column's values, the most frequent with index 0.

    Ties go by the label.  The labels are ranked by a range sort with
    per-partition offsets; they are never gathered in one place, however many
    there are.  NULL is no label.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    ranked = distributed_rank(counts, [F.col("count").desc(), F.col(col).asc()], "__rank")
    return ranked.select(col, "count", (F.col("__rank") - 1).cast("double").alias(output))


def index_labels(df: DataFrame, col: str, output: str = "label_index") -> tuple[DataFrame, DataFrame]:
    """MLR11: text/factor → 0-based double index (most frequent first), and the label table.

    The index is joined to the rows by the label; rows without a label keep a
    NULL index.
    """
    labels = label_table(df, col, output)
    side = labels.select(F.col(col).alias("__label"), output)
    return df.join(side, F.col(col) == F.col("__label"), "left").drop("__label"), labels


def index_to_text(df: DataFrame, col: str, labels: Sequence[str], output: str) -> DataFrame:
    """MLR5 helper: map a predicted index back to its label."""
    return IndexToString(inputCol=col, outputCol=output, labels=list(labels)).transform(df)


def label_names(model: PipelineModel, df: DataFrame) -> list[str] | None:
    """The text labels a formula indexed (``None`` when the label was numeric)."""
    rf = model.stages[0]
    meta = rf.transform(df.limit(0)).schema[rf.getOrDefault("labelCol")].metadata
    return meta.get("ml_attr", {}).get("vals")


def predict_labels(model: PipelineModel, df: DataFrame,
                   output: str = "predicted_label") -> DataFrame:
    """MLR5: predictions with the predicted class mapped back to its text label
    (for formulas whose label column is text)."""
    pred = predict(model, df)
    names = label_names(model, df)
    if names is None:
        return pred.withColumn(output, F.col("prediction").cast("string"))
    return index_to_text(pred, "prediction", names, output)


def fit_mlp(df: DataFrame, formula: str, layers: Sequence[int], max_iter: int = 100,
            seed: int = 1234) -> PipelineModel:
    """MLR10: multilayer perceptron classifier (announced by the recipe, not fitted there)."""
    mlp = MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, seed=seed)
    return _pipeline(df, formula, mlp)


def prediction_counts(pred: DataFrame, col: str = "prediction") -> DataFrame:
    """Rows per predicted class — a deterministic summary of a prediction run."""
    return pred.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
