"""Step 5 queries: scalar functions and date arithmetic (FN1-FN17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions import dates as D
from tabula.functions import scalar as X
from tabula.plans.registry import Tables, query, rnd


@query("math_funcs", ids=("FN1", "FN2", "FN3", "FN4"), sql="""
select l_orderkey, l_linenumber,
       ceil(l_extendedprice / 7)::bigint as price_ceil,
       floor(l_extendedprice / 7)::bigint as price_floor,
       round(l_extendedprice / 7, 2) as price_round,
       abs(l_discount - 0.05) as disc_gap,
       pow(l_quantity, 2) as qty_sq
from lineitem""")
def math_funcs(spark, d):
    li = Tables(spark, d).lineitem
    p = F.col("l_extendedprice") / 7
    return li.select("l_orderkey", "l_linenumber",
                     F.ceil(p).alias("price_ceil"), F.floor(p).alias("price_floor"),
                     rnd(p, 2).alias("price_round"),
                     F.abs(F.col("l_discount") - 0.05).alias("disc_gap"),
                     X.power("l_quantity", 2).alias("qty_sq"))


# the score is quantity plus ten times the discount, so values fall between
# the recipe's whole-number bounds (40.5, 50.7, ...) and above 50
_SCORE = "l_quantity + l_discount * 10 + (l_linenumber - 1) * 5"


@query("range_buckets", ids=("FN6",), sql=f"""
with s as (select l_orderkey, l_linenumber, {_SCORE} as score from lineitem)
select l_orderkey, l_linenumber, score,
       case when score < 30 then '<30' when score < 41 then '30-40' when score < 51 then '41-50'
            when score < 61 then '51-60' when score < 71 then '61-70' else '>70' end as bucket,
       case when score >= 30 and score <= 40 then '30-40'
            when score >= 41 and score <= 50 then '41-50'
            when score >= 51 and score <= 60 then '51-60'
            when score >= 61 and score <= 70 then '61-70'
            when score >= 71 and score <= 80 then '>70' else '<30' end as bucket_faithful,
       case when score < 30 then 0 when score < 41 then 1 when score < 51 then 2
            when score < 61 then 3 when score < 71 then 4 else 5 end as bucket_order
from s""")
def range_buckets(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber",
                                          F.expr(_SCORE).alias("score"))
    bucket = X.range_bucket("score")
    return li.select("l_orderkey", "l_linenumber", "score", bucket.alias("bucket"),
                     X.range_bucket("score", mode="faithful").alias("bucket_faithful"),
                     X.range_bucket_order(bucket).alias("bucket_order"))


@query("parse_date_fmt", ids=("FN7",), sql="""
select o_orderkey, strftime(o_orderdate, '%m/%d/%Y') as date_text,
       strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y')::date as parsed,
       epoch(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y'))::bigint as unix_seconds,
       null::date as parsed_bad
from orders""")
def parse_date_fmt(spark, d):
    o = Tables(spark, d).orders
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    return o.select("o_orderkey", text.alias("date_text"),
                    D.parse_date(text).alias("parsed"),
                    D.parse_unix_seconds(text).alias("unix_seconds"),
                    D.parse_date(F.col("o_orderpriority")).alias("parsed_bad"))


@query("parse_date_iso", ids=("FN8",), sql="""
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d')::date as iso_date,
       null::date as iso_bad
from orders""")
def parse_date_iso(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey",
                    D.parse_iso_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso_date"),
                    D.parse_iso_date(F.col("o_orderpriority")).alias("iso_bad"))


@query("month_ends", ids=("FN9",), sql="""
select o_orderkey, last_day(o_orderdate::date) as month_end from orders""")
def month_ends(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", D.month_end(F.col("o_orderdate").cast("date")).alias("month_end"))


@query("next_weekday", ids=("FN10",), sql="""
select o_orderkey, o_orderdate::date + (7 - dayofweek(o_orderdate))::int as next_sunday
from orders""")
def next_weekday(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey",
                    D.next_weekday(F.col("o_orderdate").cast("date"), "Sunday").alias("next_sunday"))


@query("add_months_days", ids=("FN11", "FN12"), sql="""
select o_orderkey, (o_orderdate::date + interval 1 month)::date as plus_month,
       o_orderdate::date + 1 as plus_day, o_orderdate::date - 1 as minus_day
from orders""")
def add_months_days(spark, d):
    o = Tables(spark, d).orders
    day = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", D.shift_months(day, 1).alias("plus_month"),
                    D.shift_days(day, 1).alias("plus_day"),
                    D.shift_days(day, -1).alias("minus_day"))


@query("date_parts", ids=("FN13", "FN16"), sql="""
select o_orderkey, weekofyear(o_orderdate)::int as week_of_year,
       dayofyear(o_orderdate)::int as day_of_year, dayofmonth(o_orderdate)::int as day_of_month,
       year(o_orderdate)::int as year, month(o_orderdate)::int as month
from orders""")
def date_parts(spark, d):
    o = Tables(spark, d).orders
    parts = D.date_parts(F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("months_days_between", ids=("FN14", "FN15"), sql="""
with j as (select l_orderkey, l_linenumber, l_shipdate::date as a, o_orderdate::date as b
           from lineitem join orders on l_orderkey = o_orderkey)
select l_orderkey, l_linenumber,
       case when day(a) = day(b) or (a = last_day(a) and b = last_day(b))
            then ((year(a) - year(b)) * 12 + month(a) - month(b))::double
            else round((year(a) - year(b)) * 12 + month(a) - month(b)
                       + (day(a) - day(b)) / 31.0, 8) end as months,
       datediff('day', b, a)::int as days
from j""")
def months_days_between(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber",
                           F.col("l_shipdate").cast("date").alias("a")).hint("merge")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                        F.col("o_orderdate").cast("date").alias("b"))
    j = li.join(o, "l_orderkey")
    return j.select("l_orderkey", "l_linenumber", D.months_between("a", "b").alias("months"),
                    D.days_between("a", "b").alias("days"))


@query("concat_text", ids=("FN17",), sql="""
select p_partkey, p_brand || '-' || p_size::varchar as label,
       concat_ws('/', p_type, p_brand) as path
from part""")
def concat_text(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", X.concat_text("p_brand", F.lit("-"), "p_size").alias("label"),
                    X.concat_text("p_type", "p_brand", sep="/").alias("path"))
