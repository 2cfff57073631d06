"""Step 6 queries: statistics on tables (STA1-STA13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.operators import stats as S
from tabula.plans.registry import Tables, query, rnd, round_doubles, sql_rounded
from tabula.plans.strategy import attach_scalars

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_table", ids=("STA1",), sql=sql_rounded("""
select 'l_quantity' as "column", count(l_quantity) as count, avg(l_quantity) as mean,
       stddev_samp(l_quantity) as stddev, min(l_quantity) as min, max(l_quantity) as max from lineitem
union all select 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice),
       stddev_samp(l_extendedprice), min(l_extendedprice), max(l_extendedprice) from lineitem
union all select 'l_discount', count(l_discount), avg(l_discount),
       stddev_samp(l_discount), min(l_discount), max(l_discount) from lineitem
union all select 'l_tax', count(l_tax), avg(l_tax), stddev_samp(l_tax), min(l_tax), max(l_tax)
       from lineitem""", ["mean", "stddev", "min", "max"]))
def describe_table(spark, d):
    return round_doubles(S.summary_table(Tables(spark, d).lineitem, _LI_NUM))


def _described(fn: str) -> str:
    return ", ".join(f"{fn.format(c)} as {c}" for c in _LI_NUM)


# the rows of Spark's text summary, its numbers read back from the text
@query("describe_text", ids=("STA1",), sql=sql_rounded(" union all ".join(
    f"select '{name}' as summary, {_described(fn)} from lineitem" for name, fn in (
        ("count", "count({})::double"), ("mean", "avg({})::double"), ("stddev", "stddev_samp({})::double"),
        ("min", "min({})::double"), ("max", "max({})::double"))), _LI_NUM, 4))
def describe_text(spark, d):
    found = S.describe(Tables(spark, d).lineitem, *_LI_NUM)
    return found.select("summary", *[rnd(F.col(c).cast("double"), 4).alias(c) for c in _LI_NUM])


@query("quantiles_exact", ids=("STA2",), sql=sql_rounded("""
select 'l_extendedprice' as "column", unnest([0.25, 0.5, 0.75]::double[]) as prob,
       unnest(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75])) as value from lineitem
union all
select 'value', unnest([0.25, 0.5, 0.75]::double[]), unnest(quantile_cont(value, [0.25, 0.5, 0.75]))
from events""", ["value"]))
def quantiles_exact(spark, d):
    t = Tables(spark, d)
    probs = [0.25, 0.5, 0.75]
    a = S.quantiles(t.lineitem, ["l_extendedprice"], probs, method="exact")
    b = S.quantiles(t.events, ["value"], probs, method="exact")
    return round_doubles(a.unionByName(b), only=["value"])


@query("quantiles_approx", ids=("STA2",), sql=sql_rounded("""
select 'l_extendedprice' as "column", unnest([0.1, 0.25, 0.5, 0.75, 0.9]::double[]) as prob,
       unnest(quantile_disc(l_extendedprice, [0.1, 0.25, 0.5, 0.75, 0.9])) as value
from lineitem
union all
select 'l_quantity', unnest([0.1, 0.25, 0.5, 0.75, 0.9]::double[]),
       unnest(quantile_disc(l_quantity, [0.1, 0.25, 0.5, 0.75, 0.9])) from lineitem""", ["value"]))
def quantiles_approx(spark, d):
    li = Tables(spark, d).lineitem
    out = S.approx_quantiles(li, ["l_extendedprice", "l_quantity"], [0.1, 0.25, 0.5, 0.75, 0.9],
                             relative_error=0.0)
    return round_doubles(out, only=["value"])


@query("quantiles_sketch_error", ids=("STA2",), sql="""
select 'l_extendedprice' as "column", unnest([0.25, 0.5, 0.75]::double[]) as prob,
       true as within_error""")
def quantiles_sketch_error(spark, d):
    # the recipe's relativeError = 0.001: the sketch's answer is not unique,
    # but its rank must lie within 0.001·n of the asked one — checked on the
    # whole column (ties count as any rank they span)
    li = Tables(spark, d).lineitem.select(F.col("l_extendedprice").alias("v"))
    probs = [0.25, 0.5, 0.75]
    q = S.approx_quantiles(li, ["v"], probs, relative_error=0.001)
    one = q.agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{j}")
                  for j, p in enumerate(probs)])
    counts = attach_scalars(li, one).agg(
        F.count(F.lit(1)).alias("n"),
        *[e for j in range(3) for e in (F.count_if(F.col("v") < F.col(f"q{j}")).alias(f"below{j}"),
                                        F.count_if(F.col("v") <= F.col(f"q{j}")).alias(f"upto{j}"))])
    tol = F.lit(0.001) * F.col("n")
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit("l_extendedprice").alias("column"), F.lit(p).alias("prob"),
        ((F.col(f"below{j}") - tol <= F.lit(p) * F.col("n"))
         & (F.lit(p) * F.col("n") <= F.col(f"upto{j}") + tol)).alias("within_error"))
        for j, p in enumerate(probs)])))


@query("quantiles_by_group", ids=("STA2",), sql=sql_rounded("""
select event_type, 'value' as "column", unnest([0.5, 0.9]::double[]) as prob,
       unnest(quantile_cont(value, [0.5, 0.9])) as value
from events group by event_type""", ["value"]))
def quantiles_by_group(spark, d):
    out = S.quantiles(Tables(spark, d).events, ["value"], [0.5, 0.9], by=["event_type"])
    return round_doubles(out, only=["value"])


@query("quantiles_large_groups", ids=("STA2", "VIZ4"), sql=sql_rounded("""
select l_returnflag, 'l_extendedprice' as "column", unnest([0.25, 0.5, 0.75]::double[]) as prob,
       unnest(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75])) as value
from lineitem group by l_returnflag""", ["value"]))
def quantiles_large_groups(spark, d):
    # each return flag holds about a third of the rows
    out = S.quantiles(Tables(spark, d).lineitem, ["l_extendedprice"], [0.25, 0.5, 0.75],
                      by=["l_returnflag"])
    return round_doubles(out, only=["value"])


@query("corr_pair", ids=("STA3",), sql="""
select l_returnflag, round(corr(l_quantity, l_extendedprice), 9) as corr
from lineitem group by 1""")
def corr_pair(spark, d):
    out = S.corr_pair(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice",
                      by=["l_returnflag"])
    return round_doubles(out, 9)


@query("cov_pair", ids=("STA4",), sql="""
select round(covar_samp(l_quantity, l_extendedprice), 4) as cov from lineitem""")
def cov_pair(spark, d):
    return round_doubles(S.cov_pair(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice"), 4)


def _corr_matrix_sql(cols, table, digits):
    rows = []
    for a in cols:
        for b in cols:
            v = "max(1.0)" if a == b else f"round(corr({a}, {b}), {digits}) + 0.0"
            rows.append(f"select '{a}' as var1, '{b}' as var2, {v}::double as value from {table}")
    return "\nunion all ".join(rows)


@query("corr_matrix_long", ids=("STA5", "STA6"),
       sql=_corr_matrix_sql(_LI_NUM, "lineitem", 2))
def corr_matrix_long(spark, d):
    return S.corr_matrix(Tables(spark, d).lineitem, _LI_NUM, digits=2)


@query("melt_means", ids=("STA6",), sql=sql_rounded("""
unpivot (select l_returnflag, avg(l_quantity) as l_quantity, avg(l_discount) as l_discount
         from lineitem group by 1)
on l_quantity, l_discount into name variable value value""", ["value"]))
def melt_means(spark, d):
    wide = Tables(spark, d).lineitem.groupBy("l_returnflag").agg(
        F.avg("l_quantity").alias("l_quantity"), F.avg("l_discount").alias("l_discount"))
    return round_doubles(S.melt(wide, ["l_returnflag"]), only=["value"])


@query("crosstab_counts", ids=("STA7",), sql="""
select o_orderstatus as o_orderstatus_o_orderpriority,
       count(*) filter (where o_orderpriority = '1-URGENT') as "1-URGENT",
       count(*) filter (where o_orderpriority = '2-HIGH') as "2-HIGH",
       count(*) filter (where o_orderpriority = '3-MEDIUM') as "3-MEDIUM",
       count(*) filter (where o_orderpriority = '4-NOT SPECIFIED') as "4-NOT SPECIFIED",
       count(*) filter (where o_orderpriority = '5-LOW') as "5-LOW"
from orders group by 1""")
def crosstab_counts(spark, d):
    return S.crosstab(Tables(spark, d).orders, "o_orderstatus", "o_orderpriority",
                      ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


@query("crosstab_long", ids=("STA7",), sql="""
select l_returnflag, l_linestatus, count(*) as count from lineitem group by 1, 2""")
def crosstab_long(spark, d):
    return S.crosstab_long(Tables(spark, d).lineitem, "l_returnflag", "l_linestatus")


_HIST_SQL = """
with s as (select min(value) as mn, max(value) as mx from events),
b as (select greatest(0, ceil(10 * ((value - mn) / (mx - mn))) - 1)::int as bin
      from events, s where value is not null),
c as (select bin, count(*) as count from b group by bin)
select g.bin::int as bin, mn + g.bin * ((mx - mn) / 10) as lower,
       mn + (g.bin + 1) * ((mx - mn) / 10) as upper,
       mn + (g.bin + 0.5) * ((mx - mn) / 10) as centroid, coalesce(c.count, 0) as count
from s, range(10) g(bin) left join c on c.bin = g.bin"""


@query("histogram_bins", ids=("STA8",), sql=sql_rounded(_HIST_SQL, ["lower", "upper", "centroid"], 9))
def histogram_bins(spark, d):
    return round_doubles(S.histogram(Tables(spark, d).events, "value", 10), 9)


@query("histogram_groups", ids=("STA8",), sql=sql_rounded("""
with s as (select event_type, min(value) as mn, max(value) as mx from events group by 1),
b as (select e.event_type, greatest(0, ceil(8 * ((value - mn) / (mx - mn))) - 1)::int as bin
      from events e join s using (event_type) where value is not null),
c as (select event_type, bin, count(*) as count from b group by 1, 2)
select s.event_type, g.bin::int as bin, mn + g.bin * ((mx - mn) / 8) as lower,
       mn + (g.bin + 1) * ((mx - mn) / 8) as upper,
       mn + (g.bin + 0.5) * ((mx - mn) / 8) as centroid, coalesce(c.count, 0) as count
from s cross join range(8) g(bin)
left join c on c.event_type = s.event_type and c.bin = g.bin""", ["lower", "upper", "centroid"], 9))
def histogram_groups(spark, d):
    return round_doubles(S.histogram(Tables(spark, d).events, "value", 8, by=["event_type"]), 9)


@query("bivar_histogram", ids=("STA9",), sql="""
with s as (select min(l_quantity) as xmn, max(l_quantity) as xmx,
                  min(l_extendedprice) as ymn, max(l_extendedprice) as ymx from lineitem),
w as (select *, (ceil(xmx) - floor(xmn)) / 99 as xw, (ceil(ymx) - floor(ymn)) / 99 as yw from s),
b as (select case when xw = 0 then 1 when ceil((l_quantity - xmn) / xw) = 0 then 1
                  else ceil((l_quantity - xmn) / xw) end::bigint as x_bin,
             case when yw = 0 then 1 when ceil((l_extendedprice - ymn) / yw) = 0 then 1
                  else ceil((l_extendedprice - ymn) / yw) end::bigint as y_bin
      from lineitem, w)
select x_bin, y_bin, count(*) as count from b group by 1, 2""")
def bivar_histogram(spark, d):
    return S.bivariate_histogram(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", 100)


@query("frequency_table", ids=("STA10",), sql="""
select p_type, count(*) as count, round(count(*) / sum(count(*)) over (), 9) as percentage
from part group by 1""")
def frequency_table(spark, d):
    return round_doubles(S.frequency_table(Tables(spark, d).part, "p_type"), 9)


@query("sample_fraction", ids=("STA11",), sql="""
select count(*) as n, 0::bigint as n_outside, true as size_fits from events""")
def sample_fraction(spark, d):
    # which rows are drawn depends on seed and layout; that they are rows of
    # the table and that their number fits the fraction does not
    events = Tables(spark, d).events
    drawn = S.sample_fraction(events, 0.05, seed=0)
    outside = drawn.join(events, "event_id", "left_anti").agg(F.count(F.lit(1)).alias("n_outside"))
    sizes = attach_scalars(events.agg(F.count(F.lit(1)).alias("n")),
                           drawn.agg(F.count(F.lit(1)).alias("__drawn")))
    return attach_scalars(sizes, outside).select(
        "n", "n_outside", _near(F.col("__drawn"), 0.05, F.col("n")).alias("size_fits"))


def _near(size, weight, n):
    """Whether a random part's size lies within five standard deviations of its weight."""
    return F.abs(size - n * weight) <= 5 * F.sqrt(n * weight * (1 - weight)) + 1


@query("random_split_sizes", ids=("STA12",), sql="""
select count(*) as n, count(*) as n_union, 0::bigint as n_overlap, true as adds_up, true as sizes_fit
from lineitem""")
def random_split_sizes(spark, d):
    # lineitem rows are distinct, so the parts must add up to the table
    lines = Tables(spark, d).lineitem
    a, b = S.random_split(lines, [0.7, 0.3], seed=42)
    return S.split_report(lines, a, b).select(
        "n", "n_union", "n_overlap", (F.col("n_first") + F.col("n_second") == F.col("n")).alias("adds_up"),
        _near(F.col("n_first"), 0.7, F.col("n")).alias("sizes_fit"))


@query("split_except_disjoint", ids=("STA13", "SET2"), sql="""
select count(*) as n, count(*) as n_union, 0::bigint as n_overlap, true as adds_up, true as sizes_fit
from orders""")
def split_except_disjoint(spark, d):
    orders = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    train, test = S.split_by_except(orders, 0.7, seed=42)
    return S.split_report(orders, train, test).select(
        "n", "n_union", "n_overlap", (F.col("n_first") + F.col("n_second") == F.col("n")).alias("adds_up"),
        _near(F.col("n_first"), 0.7, F.col("n")).alias("sizes_fit"))


@query("sample_exact", ids=("STA11",), sql="""
select o_orderkey, o_custkey, o_totalprice from orders
qualify row_number() over (order by md5('7|' || o_orderkey)) <= round(0.05 * count(*) over ())""")
def sample_exact(spark, d):
    orders = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return S.sample_exact(orders, 0.05, seed=7, key=["o_orderkey"])


@query("sample_duplicates", ids=("STA11",), sql="""
with v as (select event_type, floor(value)::bigint as whole from events),
c as (select *, row_number() over (partition by event_type, whole) as copy from v)
select event_type, whole from c
qualify row_number() over (order by md5(concat_ws('|', 3, copy, event_type, coalesce(whole::varchar, '')))) <= 1000""")
def sample_duplicates(spark, d):
    # many events are alike in these columns: equal rows are drawn one by one
    events = Tables(spark, d).events.select("event_type", F.floor("value").cast("bigint").alias("whole"))
    return S.sample_exact(events, rows=1000, seed=3)


@query("split_exact", ids=("STA12", "STA13"), sql="""
with v as (select l_returnflag, l_linestatus, l_quantity::bigint as quantity from lineitem),
c as (select *, row_number() over (partition by l_returnflag, l_linestatus, quantity) as copy from v),
h as (select *, substr(md5(concat_ws('|', 42, copy, l_returnflag, l_linestatus, quantity)), 1, 13) as draw from c)
select case when draw < printf('%013x', floor(0.7 * pow(16, 13))::bigint) then 'train' else 'test' end as part,
       l_returnflag, l_linestatus, quantity, count(*) as n from h group by all""")
def split_exact(spark, d):
    lines = Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus",
                                             F.col("l_quantity").cast("bigint").alias("quantity"))
    train, test = S.split_exact(lines, [0.7, 0.3], seed=42)
    both = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "l_returnflag", "l_linestatus", "quantity").agg(F.count(F.lit(1)).alias("n"))
