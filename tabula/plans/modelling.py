"""Step 9 queries: formula models (MLR1-MLR11).

Two kinds of check.  Where the label is a threshold of a feature, a correct
classifier predicts it exactly.  The ``*_share`` queries have labels that no
feature determines: on one categorical predictor, without penalty, a logistic
fit gives each group its share of the label, a tree's leaves hold the shares,
and one boosting step moves by the leaf's mean; a lasso penalty above the
largest gradient leaves the intercept alone; GLMs on a 0/1 predictor have
closed forms for estimates, standard errors and deviances.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabula.operators import models as M
from tabula.plans.registry import Tables, query, rnd


def _labelled(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_quantity", "l_discount", "l_returnflag", "l_extendedprice",
                     (F.col("l_quantity") > 25).cast("double").alias("big"))


_BINARY_SQL = """
select (l_quantity > 25)::int::double as prediction, count(*) as n from lineitem group by 1"""


@query("logit_binary", ids=("MLR1", "MLR2", "MLR5"), sql=_BINARY_SQL)
def logit_binary(spark, d):
    df = _labelled(spark, d)
    model = M.fit_logistic(df, "big ~ l_quantity + l_discount", max_iter=100, reg_param=0.0,
                           elastic_net=0.0)
    return M.prediction_counts(M.predict(model, df))


@query("logit_multinomial", ids=("MLR3", "MLR5"), sql="""
select (case when l_quantity <= 16 then 0 when l_quantity <= 33 then 1 else 2 end)::double
       as prediction, count(*) as n from lineitem group by 1""")
def logit_multinomial(spark, d):
    li = Tables(spark, d).lineitem
    df = li.select("l_quantity", F.when(F.col("l_quantity") <= 16, 0.0)
                   .when(F.col("l_quantity") <= 33, 1.0).otherwise(2.0).alias("band"))
    model = M.fit_logistic(df, "band ~ l_quantity", max_iter=200, reg_param=0.0,
                           elastic_net=0.0, family="multinomial")
    return M.prediction_counts(M.predict(model, df))


@query("logit_label_text", ids=("MLR3", "MLR5", "MLR11"), sql="""
select case when l_quantity <= 16 then 'low' when l_quantity <= 33 then 'mid' else 'high' end
       as predicted_label, count(*) as n
from lineitem group by 1""")
def logit_label_text(spark, d):
    # a text label: the formula indexes it, the model predicts an index, and
    # the index is mapped back to the text
    li = Tables(spark, d).lineitem
    df = li.select("l_quantity", F.when(F.col("l_quantity") <= 16, "low")
                   .when(F.col("l_quantity") <= 33, "mid").otherwise("high").alias("band"))
    model = M.fit_logistic(df, "band ~ l_quantity", max_iter=200, reg_param=0.0,
                           elastic_net=0.0, family="multinomial")
    return M.prediction_counts(M.predict_labels(model, df), "predicted_label")


@query("logit_coefficients", ids=("MLR4",), sql="""
with p as (select avg((l_quantity > 25)::int) as p from lineitem)
select 'l_discount' as feature, 0.0::double as estimate
union all select 'l_tax', 0.0
union all select '(Intercept)', round(ln(p / (1 - p)), 4) from p""")
def logit_coefficients(spark, d):
    # the recipe's settings (maxIter 10, regParam 0.3, elastic net 0.8): the
    # lasso part exceeds every gradient of these features
    df = Tables(spark, d).lineitem.select(
        "l_discount", "l_tax", (F.col("l_quantity") > 25).cast("double").alias("big"))
    model = M.fit_logistic(df, "big ~ l_discount + l_tax")
    out = M.coefficients(model, df)
    return out.select("feature", rnd("estimate", 4).alias("estimate"))


_SHARE_SQL = """
select l_returnflag, round(avg((l_discount > 0.05)::int), 3) as share from lineitem group by 1"""


def _cheap(spark, d):
    """A label that no column determines, and a categorical predictor."""
    return Tables(spark, d).lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", (F.col("l_discount") > 0.05).cast("double").alias("cheap"))


def _shares(pred, *by):
    return pred.groupBy(*by).agg(rnd(F.max(vector_to_array("probability")[1]), 3).alias("share"))


@query("logit_share", ids=("MLR2", "MLR5"), sql=_SHARE_SQL)
def logit_share(spark, d):
    df = _cheap(spark, d)
    model = M.fit_logistic(df, "cheap ~ l_returnflag", max_iter=100, reg_param=0.0, elastic_net=0.0)
    return _shares(M.predict(model, df), "l_returnflag")


@query("logit_multinomial_share", ids=("MLR3", "MLR5"), sql="""
with o as (select o_orderstatus, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 0
                                      when o_orderpriority = '3-MEDIUM' then 1 else 2 end as c from orders)
select o_orderstatus, round(avg((c = 0)::int), 3) as p0, round(avg((c = 1)::int), 3) as p1,
       round(avg((c = 2)::int), 3) as p2 from o group by 1""")
def logit_multinomial_share(spark, d):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    df = Tables(spark, d).orders.select("o_orderstatus", F.when(urgent, 0.0).when(
        F.col("o_orderpriority") == "3-MEDIUM", 1.0).otherwise(2.0).alias("c"))
    model = M.fit_logistic(df, "c ~ o_orderstatus", max_iter=200, reg_param=0.0, elastic_net=0.0,
                           family="multinomial")
    p = vector_to_array("probability")
    return M.predict(model, df).groupBy("o_orderstatus").agg(
        *[rnd(F.max(p[k]), 3).alias(f"p{k}") for k in range(3)])


@query("logit_holdout", ids=("MLR2", "MLR5", "STA12"), sql="""
with t as (select l_returnflag, avg((l_discount > 0.05)::int) as p from lineitem
           where l_orderkey % 10 < 7 group by 1)
select l_orderkey, l_linenumber, round(p, 3) as probability, (p > 0.5)::int::double as prediction
from lineitem join t using (l_returnflag) where l_orderkey % 10 >= 7""")
def logit_holdout(spark, d):
    # fitted on seven tenths of the orders, predicted for the rest, row by row
    df = _cheap(spark, d)
    train = F.col("l_orderkey") % 10 < 7
    model = M.fit_logistic(df.where(train), "cheap ~ l_returnflag", max_iter=100, reg_param=0.0, elastic_net=0.0)
    pred = M.predict(model, df.where(~train))
    return pred.select("l_orderkey", "l_linenumber",
                       rnd(vector_to_array("probability")[1], 3).alias("probability"), "prediction")


_SIDE_SQL = """
select (2000 * l_quantity + l_extendedprice > 100000)::int::double as side, round({0}, 4) as share
from lineitem group by 1"""


def _sides(spark, d):
    """A 0/1 predictor that goes with the label without determining it.

    Its sides lie on either side of one half: a tree whose leaves predict the
    same class would be pruned to one leaf.
    """
    return Tables(spark, d).lineitem.select(
        (F.col("l_quantity") > 25).cast("double").alias("big"),
        (2000 * F.col("l_quantity") + F.col("l_extendedprice") > 100_000).cast("double").alias("side"))


@query("tree_share", ids=("MLR6",), sql=_SIDE_SQL.format("avg((l_quantity > 25)::int)"))
def tree_share(spark, d):
    df = _sides(spark, d)
    model = M.fit_tree(df, "big ~ side", "decision_tree", maxDepth=1, seed=1)
    return M.predict(model, df).groupBy("side").agg(
        rnd(F.max(vector_to_array("probability")[1]), 4).alias("share"))


@query("forest_share", ids=("MLR7",), sql=_SIDE_SQL.format("avg((l_quantity > 25)::int)"))
def forest_share(spark, d):
    # all rows and features for every tree: the forest is the tree
    df = _sides(spark, d)
    model = M.fit_tree(df, "big ~ side", "random_forest", maxDepth=1, numTrees=3,
                       bootstrap=False, featureSubsetStrategy="all", seed=1)
    return M.predict(model, df).groupBy("side").agg(
        rnd(F.max(vector_to_array("probability")[1]), 4).alias("share"))


@query("gbt_share", ids=("MLR8",), sql=_SIDE_SQL.format(
    "1 / (1 + exp(-2 * (2 * avg((l_quantity > 25)::int) - 1)))"))
def gbt_share(spark, d):
    # one boosting step: the margin is the leaf's mean of labels -1 and 1
    df = _sides(spark, d)
    model = M.fit_tree(df, "big ~ side", "gbt", maxDepth=1, maxIter=1, seed=1)
    return M.predict(model, df).groupBy("side").agg(
        rnd(F.max(vector_to_array("probability")[1]), 4).alias("share"))


@query("tree_predict", ids=("MLR6",), sql=_BINARY_SQL)
def tree_predict(spark, d):
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "decision_tree", maxBins=64, seed=42)
    return M.prediction_counts(M.predict(model, df))


@query("forest_predict", ids=("MLR7",), sql=_BINARY_SQL)
def forest_predict(spark, d):
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "random_forest", numTrees=10,
                       maxBins=64, seed=42)
    return M.prediction_counts(M.predict(model, df))


@query("gbt_predict", ids=("MLR8",), sql=_BINARY_SQL)
def gbt_predict(spark, d):
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "gbt", maxIter=10, maxBins=64,
                       seed=42)
    return M.prediction_counts(M.predict(model, df))


@query("tree_importance", ids=("MLR6",), sql="""
select 'l_quantity' as feature, 1.0::double as importance, 1::int as num_trees, 1::int as depth
union all select 'l_discount', 0.0, 1, 1""")
def tree_importance(spark, d):
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "decision_tree", maxBins=64, seed=42)
    return M.tree_summary(model, df)


_ENSEMBLE_SQL = """
select 'l_quantity' as feature, 1.0::double as importance, 10::int as num_trees, 1::int as depth
union all select 'l_discount', 0.0, 10, 1"""


@query("forest_importance", ids=("MLR7",), sql=_ENSEMBLE_SQL)
def forest_importance(spark, d):
    # every tree sees both features; one of them determines the label
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "random_forest", numTrees=10, maxBins=64,
                       featureSubsetStrategy="all", seed=42)
    return M.tree_summary(model, df)


@query("gbt_importance", ids=("MLR8",), sql=_ENSEMBLE_SQL)
def gbt_importance(spark, d):
    df = _labelled(spark, d)
    model = M.fit_tree(df, "big ~ l_quantity + l_discount", "gbt", maxIter=10, maxBins=64, maxDepth=1, seed=42)
    return M.tree_summary(model, df)


@query("glm_gaussian", ids=("MLR9",), sql="""
select 'l_quantity' as feature, round(regr_slope(l_extendedprice, l_quantity), 4) as estimate
from lineitem
union all
select '(Intercept)', round(regr_intercept(l_extendedprice, l_quantity), 4) from lineitem""")
def glm_gaussian(spark, d):
    df = _labelled(spark, d)
    s = M.glm_coefficients(M.fit_glm(df, "l_extendedprice ~ l_quantity", "gaussian"), df)
    return s.select("feature", rnd("estimate", 4).alias("estimate"))


@query("glm_poisson", ids=("MLR9",), sql="""
select l_returnflag, round(avg(l_quantity), 6) as fitted from lineitem group by 1""")
def glm_poisson(spark, d):
    # one categorical predictor: the Poisson fit reproduces each group's mean
    df = _labelled(spark, d)
    model = M.fit_glm(df, "l_quantity ~ l_returnflag", "poisson")
    pred = M.predict(model, df)
    return pred.groupBy("l_returnflag").agg(rnd(F.first("prediction"), 6).alias("fitted"))


@query("glm_families", ids=("MLR9", "UDF5"), sql="""
with x as (select l_quantity as y, (l_returnflag = 'A')::int as f from lineitem),
g as (select count(*) filter (where f = 0)::double as n0, count(*) filter (where f = 1)::double as n1,
             avg(y) filter (where f = 0) as m0, avg(y) filter (where f = 1) as m1, avg(y) as m,
             count(*)::double as n from x),
d as (select sum((y - case f when 1 then m1 else m0 end) ** 2) as sse, sum((y - m) ** 2) as sst,
             2 * sum(y * ln(y / case f when 1 then m1 else m0 end) - (y - case f when 1 then m1 else m0 end)) as pd,
             2 * sum(y * ln(y / m) - (y - m)) as pn from x, g),
r as (select 'gaussian' as family, 'is_a' as feature, m1 - m0 as estimate,
             sqrt(sse / (n - 2) * (1 / n1 + 1 / n0)) as std_error, sse as deviance, sst as null_deviance from g, d
      union all select 'gaussian', '(Intercept)', m0, sqrt(sse / (n - 2) / n0), sse, sst from g, d
      union all select 'poisson', 'is_a', ln(m1 / m0), sqrt(1 / (n1 * m1) + 1 / (n0 * m0)), pd, pn from g, d
      union all select 'poisson', '(Intercept)', ln(m0), sqrt(1 / (n0 * m0)), pd, pn from g, d)
select family, feature, round(estimate, 4) as estimate, round(std_error, 5) as std_error,
       round(estimate / std_error, 2) as t_value, round(deviance / null_deviance, 6) as deviance_share
from r""")
def glm_families(spark, d):
    # one summary per family, each fit distributed (the recipe's list of fits)
    df = Tables(spark, d).lineitem.select("l_quantity", (F.col("l_returnflag") == "A").cast("double").alias("is_a"))
    out = M.fit_per_family(df, "l_quantity ~ is_a", ["gaussian", "poisson"])
    return out.select("family", "feature", rnd("estimate", 4).alias("estimate"),
                      rnd("std_error", 5).alias("std_error"), rnd("t_value", 2).alias("t_value"),
                      rnd(F.col("deviance") / F.col("null_deviance"), 6).alias("deviance_share"))


@query("label_index", ids=("MLR11",), sql="""
select o_orderpriority,
       (row_number() over (order by count(*) desc, o_orderpriority) - 1)::double as label_index
from orders group by 1""")
def label_index(spark, d):
    o = Tables(spark, d).orders.select("o_orderpriority")
    indexed, _ = M.index_labels(o, "o_orderpriority")
    return indexed.groupBy("o_orderpriority").agg(F.first("label_index").alias("label_index"))


@query("mlp_predict", ids=("MLR10",), sql=_BINARY_SQL)
def mlp_predict(spark, d):
    df = _labelled(spark, d).select("big", (F.col("l_quantity") / 50).alias("q"))
    model = M.fit_mlp(df, "big ~ q", layers=[1, 4, 2], max_iter=300, seed=7)
    return M.prediction_counts(M.predict(model, df))
