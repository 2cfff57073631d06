"""Step 8 queries: user functions over partitions, groups and lists (UDF1-UDF5).

The functions compute plain expressions (as the recipes do), so their
results are checked against SQL.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tabula.operators import groups as G
from tabula.operators import udf as U
from tabula.plans.registry import Tables, query, rnd

_NET_SCHEMA = "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double, net double"


def with_net(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per batch: the discounted price."""
    return pdf.assign(net=pdf["l_extendedprice"] * (1 - pdf["l_discount"]))


def price_range(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Per group (or part of one): extremes and total of the discounted lines' price."""
    cheaper = pdf.loc[pdf["l_discount"] > 0, "l_extendedprice"]
    return pd.DataFrame({"l_returnflag": [key[0]], "lowest": [cheaper.min()], "highest": [cheaper.max()],
                         "lines": [len(cheaper)]})


def _lines(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")


def _flagged(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_extendedprice", "l_discount")


_RANGE = {"lowest": "min", "highest": "max", "lines": "sum"}
_NET_SQL = """
select l_orderkey, l_linenumber, l_extendedprice, l_discount,
       l_extendedprice * (1 - l_discount) as net from lineitem"""
_RANGE_SQL = """
select l_returnflag, min(l_extendedprice) as lowest, max(l_extendedprice) as highest, count(*) as lines
from lineitem where l_discount > 0 group by 1"""


@query("map_partitions_fn", ids=("UDF1",), sql=_NET_SQL)
def map_partitions_fn(spark, d):
    return U.map_partitions(_lines(spark, d), with_net, _NET_SCHEMA)


@query("map_partitions_inferred", ids=("UDF2",), sql=_NET_SQL)
def map_partitions_inferred(spark, d):
    return U.map_partitions_inferred(_lines(spark, d), with_net)


@query("map_groups_fn", ids=("UDF3",), sql=_RANGE_SQL)
def map_groups_fn(spark, d):
    # each return flag holds about a third of the rows: parts of the groups,
    # merged by built-in aggregates
    return U.map_groups(_flagged(spark, d), ["l_returnflag"], price_range,
                        "l_returnflag string, lowest double, highest double, lines long", _RANGE)


@query("map_groups_inferred", ids=("UDF4",), sql=_RANGE_SQL)
def map_groups_inferred(spark, d):
    return U.map_groups_inferred(_flagged(spark, d), ["l_returnflag"], price_range, _RANGE)


def ols_from_moments(pdf: pd.DataFrame) -> pd.DataFrame:
    """Work item: a least-squares line from one group's sufficient statistics."""
    n, sx, sy = pdf["n"], pdf["sx"], pdf["sy"]
    sxx, sxy = pdf["sxx"], pdf["sxy"]
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    intercept = (sy - slope * sx) / n
    return pd.DataFrame({"l_returnflag": pdf["l_returnflag"],
                         "slope": slope.round(6), "intercept": intercept.round(4)})


@query("map_list_fn", ids=("UDF5",), sql="""
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept
from lineitem group by 1""")
def map_list_fn(spark, d):
    # the work items (one per return flag) are sufficient statistics that Spark
    # aggregates from the whole table; each item is then handled by one task
    li = Tables(spark, d).lineitem
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    items = li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    return U.map_list(items, ["l_returnflag"], ols_from_moments, "l_returnflag string, slope double, intercept double")


@query("map_groups_sorted", ids=("SRT2", "UDF4"), sql=_RANGE_SQL + " order by highest desc")
def map_groups_sorted(spark, d):
    # the distributed result is sorted before anything is collected
    out = U.map_groups_inferred(_flagged(spark, d), ["l_returnflag"], price_range, _RANGE)
    return G.sort_by(out, "highest", descending=True)


_MEAN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def part_sums(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Per-part sums and row count, so that means merge exactly across parts."""
    out = {"l_returnflag": [key[0]], "n": [len(pdf)]}
    out.update({f"sum_{c}": [float(pdf[c].sum())] for c in _MEAN_COLS})
    return pd.DataFrame(out)


@query("map_groups_means", ids=("UDF3",), sql="""
select l_returnflag, round(avg(l_quantity), 6) as mean_l_quantity,
       round(avg(l_extendedprice), 6) as mean_l_extendedprice,
       round(avg(l_discount), 6) as mean_l_discount, round(avg(l_tax), 6) as mean_l_tax
from lineitem group by 1""")
def map_groups_means(spark, d):
    # the recipe's per-group function returns five means; split into parts, a
    # mean is carried as (sum, count) and divided after the parts are merged
    li = Tables(spark, d).lineitem.select("l_returnflag", *_MEAN_COLS)
    schema = "l_returnflag string, n long, " + ", ".join(f"sum_{c} double" for c in _MEAN_COLS)
    sums = U.map_groups(li, ["l_returnflag"], part_sums, schema,
                        combine={"n": "sum", **{f"sum_{c}": "sum" for c in _MEAN_COLS}})
    return sums.select("l_returnflag", *[rnd(F.col(f"sum_{c}") / F.col("n")).alias(f"mean_{c}")
                                         for c in _MEAN_COLS])
