"""Step 3 queries: missing data (NA1-NA9, FLT6-FLT8, FN5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import columns as C
from tabula.plans.derived import GAPS_SQL, orders_with_gaps
from tabula.plans.registry import Tables, query

_ALL = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate"


def _gaps(spark, d):
    return orders_with_gaps(Tables(spark, d))


@query("dropna_any", ids=("NA3",), sql=GAPS_SQL + f"""
select {_ALL} from og
where o_orderstatus is not null and o_orderpriority is not null
  and o_totalprice is not null and not isnan(o_totalprice)""")
def dropna_any(spark, d):
    return C.drop_missing(_gaps(spark, d), how="any")


@query("dropna_all", ids=("NA2",), sql=GAPS_SQL + f"""
select {_ALL} from og
where not (o_orderstatus is null and o_orderpriority is null
           and (o_totalprice is null or isnan(o_totalprice)))""")
def dropna_all(spark, d):
    return C.drop_missing(_gaps(spark, d), how="all",
                          subset=["o_orderstatus", "o_orderpriority", "o_totalprice"])


@query("dropna_subset", ids=("NA1",), sql=GAPS_SQL + f"""
select {_ALL} from og where o_orderstatus is not null""")
def dropna_subset(spark, d):
    return C.drop_missing(_gaps(spark, d), subset=["o_orderstatus"])


@query("dropna_thresh", ids=("NA4",), sql=GAPS_SQL + f"""
select {_ALL} from og
where (case when o_orderstatus is null then 0 else 1 end)
    + (case when o_orderpriority is null then 0 else 1 end)
    + (case when o_totalprice is null or isnan(o_totalprice) then 0 else 1 end) + 3 >= 5""")
def dropna_thresh(spark, d):
    return C.drop_missing(_gaps(spark, d), min_non_nulls=5)


@query("fillna_value", ids=("NA5",), sql=GAPS_SQL + """
select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       case when o_totalprice is null or isnan(o_totalprice) then -1.0
            else o_totalprice end as o_totalprice,
       o_orderdate
from og""")
def fillna_value(spark, d):
    return C.fill_missing(_gaps(spark, d), -1)


@query("fillna_map", ids=("NA6",), sql=GAPS_SQL + """
select o_orderkey, o_custkey, coalesce(o_orderstatus, 'none') as o_orderstatus,
       coalesce(o_orderpriority, '0-MISSING') as o_orderpriority, o_totalprice, o_orderdate
from og""")
def fillna_map(spark, d):
    return C.fill_missing(_gaps(spark, d), {"o_orderstatus": "none",
                                            "o_orderpriority": "0-MISSING"})


@query("ifelse_replace", ids=("NA7", "FN5"), sql=GAPS_SQL + """
select o_orderkey, case when o_orderstatus = '' then '?' else o_orderstatus end
       as o_orderstatus from og""")
def ifelse_replace(spark, d):
    g = _gaps(spark, d).select("o_orderkey", "o_orderstatus")
    return C.replace_blank(g, "o_orderstatus", "?")


@query("null_counts", ids=("NA8",), sql=GAPS_SQL + """
select 'o_orderkey' as "column", count(*) filter (where o_orderkey is null) as nulls from og
union all select 'o_custkey', count(*) filter (where o_custkey is null) from og
union all select 'o_orderstatus', count(*) filter (where o_orderstatus is null) from og
union all select 'o_orderpriority', count(*) filter (where o_orderpriority is null) from og
union all select 'o_totalprice', count(*) filter (where o_totalprice is null) from og
union all select 'o_orderdate', count(*) filter (where o_orderdate is null) from og""")
def null_counts(spark, d):
    return C.null_counts(_gaps(spark, d))


@query("null_group_count", ids=("NA9",), sql=GAPS_SQL + """
select o_orderpriority, count(*) as nulls from og where o_totalprice is null group by 1""")
def null_group_count(spark, d):
    return C.null_group_count(_gaps(spark, d), "o_totalprice", ["o_orderpriority"])


@query("null_filters", ids=("FLT6",), sql=GAPS_SQL + """
select count(*) filter (where o_orderstatus is not null) as n_not_null,
       count(*) filter (where o_orderstatus is null) as n_null from og""")
def null_filters(spark, d):
    g = _gaps(spark, d)
    return g.agg(F.count_if(F.col("o_orderstatus").isNotNull()).alias("n_not_null"),
                 F.count_if(F.col("o_orderstatus").isNull()).alias("n_null"))


@query("not_nan_filter", ids=("FLT7",), sql=GAPS_SQL + """
select o_orderkey, o_totalprice from og where o_totalprice is null or not isnan(o_totalprice)""")
def not_nan_filter(spark, d):
    g = _gaps(spark, d).select("o_orderkey", "o_totalprice")
    return g.where(C.not_nan("o_totalprice"))


@query("non_empty_filter", ids=("FLT8",), sql=GAPS_SQL + """
select o_orderkey, o_orderstatus from og where o_orderstatus != ''""")
def non_empty_filter(spark, d):
    g = _gaps(spark, d).select("o_orderkey", "o_orderstatus")
    return g.where(C.non_empty("o_orderstatus"))
