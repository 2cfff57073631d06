"""Step 4 queries: joins and set operations (JOIN1-JOIN4, SET1-SET6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import joins as J
from tabula.operators import setops as S
from tabula.plans.derived import PARTIES_SQL, customers_as_parties, suppliers_as_parties
from tabula.plans.registry import Tables, query, rnd


@query("join_drop_key", ids=("JOIN1",), sql="""
select l_orderkey as orderkey, l_linenumber, l_quantity, o_orderstatus, o_totalprice
from lineitem join orders on l_orderkey = o_orderkey""")
def join_drop_key(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity") \
        .hint("merge")  # the fact table: sort-merge join, never a broadcast
    o = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_totalprice")
    return J.join_drop_key(li, o, "orderkey")


@query("join_group_stats", ids=("JOIN1", "AGG1"), sql="""
select o_orderstatus, count(*) as count, round(avg(o_totalprice), 6) as price_avg
from orders group by 1""")
def join_group_stats(spark, d):
    # the recipe's "count by gender ⋈ mean by gender on gender, drop the copy"
    o = Tables(spark, d).orders
    counts = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("count"))
    means = o.groupBy("o_orderstatus").agg(rnd(F.avg("o_totalprice"), 6).alias("price_avg"))
    return J.join_drop_key(counts, means, "o_orderstatus")


@query("merge_suffixes", ids=("JOIN2",), sql="""
with c as (select c_nationkey as nationkey, count(*) as n, round(avg(c_acctbal), 6) as acctbal
           from customer group by 1),
     s as (select s_nationkey as nationkey, count(*) as n, round(avg(s_acctbal), 6) as acctbal
           from supplier group by 1)
select c.nationkey as nationkey_x, c.n as n_x, c.acctbal as acctbal_x,
       s.nationkey as nationkey_y, s.n as n_y, s.acctbal as acctbal_y
from c join s on c.nationkey = s.nationkey""")
def merge_suffixes(spark, d):
    t = Tables(spark, d)
    c = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("c_acctbal"), 6).alias("acctbal"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("s_acctbal"), 6).alias("acctbal"))
    return J.merge(c, s, "nationkey")


@query("scalar_stats_join", ids=("JOIN3",), sql="""
select l_orderkey, l_linenumber, l_quantity,
       (l_quantity - mn) / (mx - mn) as qty_scaled
from lineitem, (select min(l_quantity) as mn, max(l_quantity) as mx from lineitem) s""")
def scalar_stats_join(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    withs = J.with_scalar_stats(li, {"mn": F.min("l_quantity"), "mx": F.max("l_quantity")})
    return withs.select("l_orderkey", "l_linenumber", "l_quantity",
                        ((F.col("l_quantity") - F.col("mn")) / (F.col("mx") - F.col("mn")))
                        .alias("qty_scaled"))


@query("grid_points", ids=("JOIN4",), sql="""
with s as (select min(l_quantity) as qlo, max(l_quantity) as qhi,
                  min(l_discount) as dlo, max(l_discount) as dhi from lineitem)
select i as qty_index, j as disc_index,
       round(qlo + i * (qhi - qlo) / 9, 9) as qty, round(dlo + j * (dhi - dlo) / 4, 9) as disc
from s, range(10) a(i), range(5) b(j)""")
def grid_points(spark, d):
    g = J.grid(Tables(spark, d).lineitem, {"qty": ("l_quantity", 10), "disc": ("l_discount", 5)})
    return g.select(F.col("qty_index").cast("long").alias("qty_index"),
                    F.col("disc_index").cast("long").alias("disc_index"),
                    rnd("qty", 9).alias("qty"), rnd("disc", 9).alias("disc"))


@query("append_rows", ids=("SET1",), sql="""
select o_orderkey, o_orderstatus, o_totalprice from orders""")
def append_rows(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    # a condition, its null-safe complement, and a part of that
    done = F.col("o_orderstatus").eqNullSafe("F")
    large = F.coalesce(F.col("o_totalprice") > 150_000, F.lit(False))
    return S.append_rows(o.where(done), o.where(~done & large), o.where(~done & ~large))


@query("union_all", ids=("SET4",), sql="""
select o_orderkey, o_totalprice from orders""")
def union_all(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    even = (F.col("o_orderkey") % 2).eqNullSafe(0)
    return S.union_all(o.where(even), o.where(~even))


@query("except_rows", ids=("SET2",), sql="""
select o_custkey, o_orderstatus from orders
except select o_custkey, o_orderstatus from orders where o_totalprice > 100000""")
def except_rows(spark, d):
    o = Tables(spark, d).orders
    a = o.select("o_custkey", "o_orderstatus")
    b = o.where(F.col("o_totalprice") > 100000).select("o_custkey", "o_orderstatus")
    return S.except_rows(a, b)


@query("intersect_rows", ids=("SET3",), sql="""
select o_custkey, o_orderpriority from orders where o_orderstatus = 'F'
intersect select o_custkey, o_orderpriority from orders where o_orderstatus = 'O'""")
def intersect_rows(spark, d):
    o = Tables(spark, d).orders
    a = o.where(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderpriority")
    b = o.where(F.col("o_orderstatus") == "O").select("o_custkey", "o_orderpriority")
    return S.intersect_rows(a, b)


@query("append_common_cols", ids=("SET5",), sql=PARTIES_SQL + """
select acctbal, name, nationkey from cu union all select acctbal, name, nationkey from su""")
def append_common_cols(spark, d):
    t = Tables(spark, d)
    return S.append_common(customers_as_parties(t), suppliers_as_parties(t))


@query("append_fill_cols", ids=("SET6",), sql=PARTIES_SQL + """
select acctbal, name, nationkey, segment from cu
union all select acctbal, name, nationkey, null as segment from su""")
def append_fill_cols(spark, d):
    t = Tables(spark, d)
    return S.append_fill(customers_as_parties(t), suppliers_as_parties(t))


@query("append_fill_text", ids=("SET6",), sql=PARTIES_SQL + """
select acctbal, name, nationkey, segment from cu
union all select acctbal, name, nationkey, '' as segment from su""")
def append_fill_text(spark, d):
    t = Tables(spark, d)
    return S.append_fill(customers_as_parties(t), suppliers_as_parties(t), fill="")


@query("join_salted", ids=("JOIN1",), sql="""
select o_orderstatus, count(*) as n, round(sum(l_extendedprice), 2) as revenue
from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def join_salted(spark, d):
    # the same key join with hot order keys split, if there are any: only their
    # orders rows are copied, and the result is unchanged
    t = Tables(spark, d)
    li = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice")
    o = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    j = J.join_drop_key(li, o, "orderkey", split_hot=True)
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                          rnd(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("join_hot_key", ids=("JOIN1",), sql="""
select l_orderkey, l_linenumber, l_returnflag, n, round(l_extendedprice / mean, 9) as ratio
from lineitem join (select l_returnflag, count(*) as n, avg(l_extendedprice) as mean
                    from lineitem group by 1) using (l_returnflag)""")
def join_hot_key(spark, d):
    # every return flag holds a third of the rows or so: each is a hot key
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    stats = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.avg("l_extendedprice").alias("mean"))
    joined = J.join_drop_key(li, stats, "l_returnflag", split_hot=True)
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag", "n",
                         rnd(F.col("l_extendedprice") / F.col("mean"), 9).alias("ratio"))
