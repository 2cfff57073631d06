"""Step 2 queries: grouping and aggregation (AGG1-AGG17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import columns as C
from tabula.operators import groups as G
from tabula.plans.derived import GAPS_SQL, orders_with_gaps
from tabula.plans.registry import Tables, query, rnd


@query("group_count", ids=("AGG1",), sql="""
select l_returnflag, l_linestatus, count(*) as count from lineitem group by 1, 2""")
def group_count(spark, d):
    return G.group_count(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"])


@query("count_nonnull", ids=("AGG2",), sql=GAPS_SQL + """
select o_orderpriority, count(o_orderstatus) as count from og group by 1""")
def count_nonnull(spark, d):
    return G.count_non_null(orders_with_gaps(Tables(spark, d)), ["o_orderpriority"],
                            "o_orderstatus")


@query("group_sum", ids=("AGG3",), sql="""
select l_returnflag, sum(l_quantity) as sum_qty, sum(l_linenumber)::bigint as sum_line,
       round(sum(l_extendedprice), 2) as sum_price
from lineitem group by 1""")
def group_sum(spark, d):
    return G.group_agg(Tables(spark, d).lineitem, ["l_returnflag"], {
        "sum_qty": F.sum("l_quantity"),
        "sum_line": F.sum("l_linenumber"),
        "sum_price": rnd(F.sum("l_extendedprice"), 2),
    })


@query("group_means", ids=("AGG4",), sql="""
select l_returnflag,
       round(avg(l_quantity), 6) as avg_qty, round(avg(l_extendedprice), 6) as avg_price,
       round(avg(l_discount), 6) as avg_disc, round(avg(l_tax), 6) as avg_tax
from lineitem group by 1""")
def group_means(spark, d):
    return G.group_agg(Tables(spark, d).lineitem, ["l_returnflag"], {
        "avg_qty": rnd(F.avg("l_quantity")),
        "avg_price": rnd(F.avg("l_extendedprice")),
        "avg_disc": rnd(F.avg("l_discount")),
        "avg_tax": rnd(F.avg("l_tax")),
    })


@query("global_mean", ids=("AGG7",), sql="""
select round(avg(value), 6) as mean from events""")
def global_mean(spark, d):
    return G.group_agg(Tables(spark, d).events, [], {"mean": rnd(F.avg("value"))})


@query("min_max_range", ids=("AGG5", "AGG6"), sql="""
select o_orderpriority, min(o_totalprice) as minimum, max(o_totalprice) as maximum,
       abs(max(o_totalprice) - min(o_totalprice)) as range
from orders group by 1""")
def min_max_range(spark, d):
    return G.min_max_range(Tables(spark, d).orders, "o_totalprice", ["o_orderpriority"])


_MOMENT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _moments_sql(stat_sql: dict[str, str]) -> str:
    parts = []
    for c in _MOMENT_COLS + ["value"]:
        src = "events" if c == "value" else "lineitem"
        exprs = ", ".join(f"{e.format(x=c)} as {n}" for n, e in stat_sql.items())
        parts.append(f"select '{c}' as \"column\", {exprs} "
                     f"from {src}, (select avg({c}) as u from {src}) m")
    return "\nunion all ".join(parts)


def _moments_query(spark, d, stats, digits):
    t = Tables(spark, d)
    li = G.moments(t.lineitem, _MOMENT_COLS, stats)
    ev = G.moments(t.events, ["value"], stats)
    out = li.unionByName(ev)
    return out.select("column", *[rnd(s, digits).alias(s) for s in stats])


@query("variance_all", ids=("AGG8",), sql=_moments_sql({
    "variance": "round(var_samp({x}), 4)"}))
def variance_all(spark, d):
    return _moments_query(spark, d, ["variance"], 4)


@query("stddev_all", ids=("AGG9",), sql=_moments_sql({
    "stddev": "round(stddev_samp({x}), 6)"}))
def stddev_all(spark, d):
    return _moments_query(spark, d, ["stddev"], 6)


@query("skewness_all", ids=("AGG10",), sql=_moments_sql({
    "skewness": "round(avg(pow({x} - u, 3)) / pow(avg(pow({x} - u, 2)), 1.5), 6)"}))
def skewness_all(spark, d):
    return _moments_query(spark, d, ["skewness"], 6)


@query("kurtosis_all", ids=("AGG11",), sql=_moments_sql({
    "kurtosis": "round(kurtosis_pop({x}), 6)"}))
def kurtosis_all(spark, d):
    return _moments_query(spark, d, ["kurtosis"], 6)


@query("count_distinct", ids=("AGG12",), sql="""
select l_returnflag, count(distinct l_partkey) as n_distinct from lineitem group by 1""")
def count_distinct(spark, d):
    return G.count_distinct(Tables(spark, d).lineitem, "l_partkey", ["l_returnflag"])


@query("cube_avg", ids=("AGG13",), sql="""
select l_returnflag, l_linestatus, l_linenumber,
       round(avg(l_quantity), 6) as avg_qty,
       grouping_id(l_returnflag, l_linestatus, l_linenumber)::bigint as grouping_id
from lineitem group by cube (l_returnflag, l_linestatus, l_linenumber)""")
def cube_avg(spark, d):
    return G.cube_agg(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"],
                      {"avg_qty": rnd(F.avg("l_quantity"))})


@query("rollup_avg", ids=("AGG14",), sql="""
select l_returnflag, l_linestatus, l_linenumber,
       round(avg(l_quantity), 6) as avg_qty,
       grouping_id(l_returnflag, l_linestatus, l_linenumber)::bigint as grouping_id
from lineitem group by rollup (l_returnflag, l_linestatus, l_linenumber)""")
def rollup_avg(spark, d):
    return G.rollup_agg(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"],
                        {"avg_qty": rnd(F.avg("l_quantity"))})


@query("filtered_group_agg", ids=("AGG15",), sql="""
select l_returnflag, round(avg(l_extendedprice), 6) as price_avg, count(*) as count
from lineitem where l_quantity >= 25 group by 1""")
def filtered_group_agg(spark, d):
    li = Tables(spark, d).lineitem.where(F.col("l_quantity") >= 25)
    return G.group_agg(li, ["l_returnflag"], {
        "price_avg": rnd(F.avg("l_extendedprice")), "count": F.count(F.lit(1))})


@query("resample_month", ids=("AGG16", "AGG17"), sql="""
select date_trunc('month', ts)::date as period, event_type,
       count(*) as n, round(avg(value), 6) as value_avg
from events group by 1, 2""")
def resample_month(spark, d):
    return G.resample(Tables(spark, d).events, "ts", "month", {
        "n": F.count(F.lit(1)), "value_avg": rnd(F.avg("value"))}, by=["event_type"])


@query("resample_year", ids=("AGG16", "AGG17"), sql="""
select date_trunc('year', o_orderdate)::date as period, o_orderstatus,
       count(*) as n, round(avg(o_totalprice), 6) as price_avg
from orders group by 1, 2""")
def resample_year(spark, d):
    return G.resample(Tables(spark, d).orders, "o_orderdate", "year", {
        "n": F.count(F.lit(1)), "price_avg": rnd(F.avg("o_totalprice"))}, by=["o_orderstatus"])


@query("cached_aggregates", ids=("ACT7",), sql="""
select l_returnflag, count(*) as n, round(avg(l_extendedprice), 6) as price_avg,
       max(l_quantity) as qty_max, min(l_quantity) as qty_min
from lineitem group by 1""")
def cached_aggregates(spark, d):
    li = Tables(spark, d).lineitem.select("l_returnflag", "l_quantity", "l_extendedprice")

    def several(t):
        # two separate aggregations read the cached projection instead of the files
        a = G.group_agg(t, ["l_returnflag"], {"n": F.count(F.lit(1)),
                                              "price_avg": rnd(F.avg("l_extendedprice"))})
        b = G.group_agg(t, ["l_returnflag"], {"qty_max": F.max("l_quantity"),
                                              "qty_min": F.min("l_quantity")})
        return a.join(b, "l_returnflag")

    return C.with_cache(li, several)
