"""Step 1 queries: projection, filters, ordering, dimensions, SQL views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.functions.scalar import safe_cast
from tabula.operators import columns as C
from tabula.operators import groups as G
from tabula.plans.registry import Tables, query, rnd


@query("select_cols", ids=("SRC8", "PRJ1"), sql="""
select l_orderkey, l_partkey, l_quantity from lineitem""")
def select_cols(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_partkey", "l_quantity")


@query("select_computed", ids=("PRJ2", "FN2"), sql="""
select l_orderkey, l_linenumber, l_returnflag,
       abs(l_extendedprice - l_quantity * 1000) as gap
from lineitem""")
def select_computed(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1000).alias("gap"))


@query("filter_or", ids=("FLT1", "FLT2", "FLT4"), sql="""
select o_orderkey, o_orderstatus, o_totalprice from orders
where (o_orderstatus = 'F' or o_orderstatus = 'O') and o_totalprice > 20000""")
def filter_or(spark, d):
    o = Tables(spark, d).orders
    cond = ((o.o_orderstatus == "F") | (o.o_orderstatus == "O")) & (o.o_totalprice > 20000)
    return o[cond].select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("filter_sql_text", ids=("FLT3",), sql="""
select o_orderkey, o_orderstatus, o_orderpriority from orders
where o_orderstatus = 'F' or o_orderstatus = 'O'""")
def filter_sql_text(spark, d):
    o = Tables(spark, d).orders
    return o.where("o_orderstatus = 'F' or o_orderstatus = 'O'").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority")


@query("filter_like", ids=("FLT5", "SQL1", "SQL2"), sql="""
select p_partkey, p_type from part where p_type like 'PROMO%' or p_type like '%TIN'""")
def filter_like(spark, d):
    Tables(spark, d).part.createOrReplaceTempView("part")
    return spark.sql("select p_partkey, p_type from part "
                     "where p_type like 'PROMO%' or p_type like '%TIN'")


@query("sql_view", ids=("SQL1", "SQL2", "FLT9"), sql="""
select c_name, c_acctbal from customer where c_acctbal >= 1000 and c_acctbal <= 5000""")
def sql_view(spark, d):
    Tables(spark, d).customer.createOrReplaceTempView("customer")
    return spark.sql("select c_name, c_acctbal from customer "
                     "where c_acctbal >= :lo and c_acctbal <= :hi",
                     args={"lo": 1000, "hi": 5000})


@query("subset_rows_cols", ids=("PRJ3", "PRJ4"), sql="""
select o_orderkey, o_totalprice, o_orderpriority from orders where o_orderstatus = 'F'""")
def subset_rows_cols(spark, d):
    o = Tables(spark, d).orders
    return C.subset(o, F.col("o_orderstatus") == "F",
                    ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query("cols_by_position", ids=("PRJ5",), sql="""
select l_orderkey, l_quantity, l_extendedprice from lineitem""")
def cols_by_position(spark, d):
    return C.select_positions(Tables(spark, d).lineitem, [1, 5, 6])


@query("cols_sorted", ids=("PRJ6",), sql="""
select c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey from customer""")
def cols_sorted(spark, d):
    return C.select_sorted(Tables(spark, d).customer)


@query("rename_cols", ids=("PRJ9",), sql="""
select o_orderkey, o_custkey, o_orderstatus as status, o_totalprice,
       o_orderdate, o_orderpriority as priority from orders""")
def rename_cols(spark, d):
    return C.rename_columns(Tables(spark, d).orders,
                            {"o_orderstatus": "status", "o_orderpriority": "priority"})


@query("drop_cols", ids=("PRJ10",), sql="""
select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders""")
def drop_cols(spark, d):
    return C.drop_columns(Tables(spark, d).orders, "o_orderdate", "o_custkey")


@query("transform_cols", ids=("PRJ7", "PRJ8", "FN1"), sql="""
select l_orderkey, l_linenumber, l_quantity,
       l_quantity * 0.5 as half_qty,
       l_quantity + l_extendedprice as qty_plus_price,
       pow(l_quantity, 2) as sq_qty,
       l_extendedprice / l_quantity - 1 as unit_minus_one
from lineitem""")
def transform_cols(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                                          "l_extendedprice")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return C.add_columns(li, {
        "half_qty": q * 0.5,
        "qty_plus_price": q + p,
        "sq_qty": F.pow(q, 2),
        "unit_minus_one": p / q - 1,
    }).drop("l_extendedprice")


@query("cast_cols", ids=("PRJ11", "PRJ12"), sql="""
select cast(o_orderkey as varchar) as orderkey_text,
       try_cast(o_orderpriority as integer) as priority_bad,
       try_cast(substr(o_orderpriority, 1, 1) as integer) as priority_num,
       cast(o_orderdate as date) as order_day,
       cast(round(o_totalprice) as bigint) as price_whole,
       0 as zero
from orders""")
def cast_cols(spark, d):
    o = Tables(spark, d).orders
    return o.select(
        F.col("o_orderkey").cast("string").alias("orderkey_text"),
        safe_cast("o_orderpriority", "int").alias("priority_bad"),
        safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("priority_num"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        # a double → integer cast truncates in Spark; round first for the
        # nearest whole number
        rnd("o_totalprice", 0).cast("long").alias("price_whole"),
        F.lit(0).alias("zero"),
    )


@query("share_of_total", ids=("PRJ13", "STA10", "AGG1"), sql="""
select o_orderpriority, count(*) as count,
       round(count(*) / sum(count(*)) over (), 6) as percentage
from orders group by o_orderpriority""")
def share_of_total(spark, d):
    counts = G.group_count(Tables(spark, d).orders, ["o_orderpriority"])
    return C.share_of_total(counts).withColumn("percentage", rnd("percentage"))


@query("sort_desc", ids=("SRT1",), sql="""
select p_brand, count(*) as count from part group by p_brand order by count desc""")
def sort_desc(spark, d):
    counts = G.group_count(Tables(spark, d).part, ["p_brand"])
    return G.sort_by(counts, "count", descending=True)


@query("topk_groups", ids=("SRT3",), sql="""
select p_size, count(*) as count from part group by p_size
order by count desc, p_size asc limit 5""")
def topk_groups(spark, d):
    counts = G.group_count(Tables(spark, d).part, ["p_size"])
    return G.sort_by(counts, "count", "p_size", descending=[True, False]).limit(5)


@query("reorder_rank", ids=("SRT4",), sql="""
select o_orderpriority, round(avg_price, 6) as avg_price,
       row_number() over (order by avg_price) as rank
from (select o_orderpriority, avg(o_totalprice) as avg_price from orders group by 1)""")
def reorder_rank(spark, d):
    means = Tables(spark, d).orders.groupBy("o_orderpriority").agg(
        F.avg("o_totalprice").alias("avg_price"))
    return G.rank_categories(means, "avg_price").withColumn("avg_price", rnd("avg_price"))


@query("head_rows", ids=("ACT1", "ACT2"), sql="""
select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 10""")
def head_rows(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return G.top_k(o, 10, "o_orderkey", descending=False)


@query("head_file_order", ids=("ACT1", "ACT6"), sql="""
select l_orderkey, l_linenumber, l_quantity, l_extendedprice from lineitem limit 25""")
def head_file_order(spark, d):
    # the file's first rows, whatever they hold (the SQL reader keeps file order)
    return G.head(Tables(spark, d).lineitem, 25).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("table_dims", ids=("ACT5",), sql="""
select count(*) as n_rows, 11::bigint as n_cols from lineitem""")
def table_dims(spark, d):
    return C.table_dims(Tables(spark, d).lineitem)


@query("column_profile", ids=("ACT6",), sql="""
select 1 as position, 'o_orderkey' as "column", 'bigint' as data_type, count(o_orderkey) as non_null from orders
union all select 2, 'o_custkey', 'bigint', count(o_custkey) from orders
union all select 3, 'o_orderstatus', 'string', count(o_orderstatus) from orders
union all select 4, 'o_totalprice', 'double', count(o_totalprice) from orders
union all select 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) from orders
union all select 6, 'o_orderpriority', 'string', count(o_orderpriority) from orders""")
def column_profile(spark, d):
    return C.column_profile(Tables(spark, d).orders).drop("distinct_approx")


@query("filter_like_df", ids=("FLT5",), sql="""
select p_partkey, p_type from part where p_type like '%ANODIZED%' or p_type like '%STEEL%'""")
def filter_like_df(spark, d):
    # the same LIKE filter written with column expressions; it reaches the
    # Parquet reader as StringContains filters
    p = Tables(spark, d).part
    return p.where(C.contains_any("p_type", ["%ANODIZED%", "%STEEL%"])).select("p_partkey", "p_type")
