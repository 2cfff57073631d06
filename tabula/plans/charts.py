"""Step 7 queries: the statistics behind the charts (VIZ1-VIZ19)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tabula.operators import chartdata as V
from tabula.operators import stats as S
from tabula.plans.registry import Tables, query, rnd, round_doubles, sql_rounded


@query("bar_counts", ids=("VIZ1",), sql="""
select o_orderstatus, o_orderpriority, year(o_orderdate)::int as year, count(*) as count
from orders group by 1, 2, 3""")
def bar_counts(spark, d):
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    return V.bar_counts(o, ["o_orderstatus", "o_orderpriority", "year"])


@query("bar_share", ids=("VIZ2",), sql="""
select o_orderpriority, o_orderstatus, count(*) as count,
       round(count(*) / sum(count(*)) over (partition by o_orderpriority), 9) as share
from orders group by 1, 2""")
def bar_share(spark, d):
    return round_doubles(V.bar_share(Tables(spark, d).orders, "o_orderpriority", "o_orderstatus"), 9)


@query("dotplot_bins", ids=("VIZ3",), sql="""
select floor(value / 5.0)::bigint as bin, count(*) as count,
       (floor(value / 5.0) + 0.5) * 5.0 as center
from events where value is not null group by 1, 3""")
def dotplot_bins(spark, d):
    return V.dotplot_bins(Tables(spark, d).events, "value", 5.0)


_BOX_SQL = """
with v as (select event_type, value from events where value is not null),
q as (select event_type, count(*) as n, quantile_cont(value, 0.25) as q1,
             quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3
      from v group by 1),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence,
             q3 + 1.5 * (q3 - q1) as upper_fence from q)
select f.event_type, n, q1, median, q3, iqr, lower_fence, upper_fence,
       min(case when value >= lower_fence then value end) as whisker_low,
       max(case when value <= upper_fence then value end) as whisker_high,
       count(*) filter (where value < lower_fence or value > upper_fence) as n_outliers
from f join v using (event_type)
group by f.event_type, n, q1, median, q3, iqr, lower_fence, upper_fence"""

_BOX_COLS = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low",
             "whisker_high"]


@query("box_stats", ids=("VIZ4",), sql=sql_rounded(_BOX_SQL, _BOX_COLS))
def box_stats(spark, d):
    return round_doubles(V.box_stats(Tables(spark, d).events, "value", ["event_type"]))


@query("box_outliers", ids=("VIZ4",), sql="""
with q as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
           from events where value is not null group by 1)
select e.event_type, e.event_id, e.value from events e join q using (event_type)
where e.value < q1 - 1.5 * (q3 - q1) or e.value > q3 + 1.5 * (q3 - q1)""")
def box_outliers(spark, d):
    return V.box_outliers(Tables(spark, d).events, "value", ["event_type"], keep=["event_id"])


@query("notch_stats", ids=("VIZ5",), sql=sql_rounded("""
with q as (select count(*) as n, quantile_cont(l_extendedprice, 0.25) as q1,
                  quantile_cont(l_extendedprice, 0.5) as median,
                  quantile_cont(l_extendedprice, 0.75) as q3 from lineitem),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence,
             q3 + 1.5 * (q3 - q1) as upper_fence from q)
select n, q1, median, q3, iqr, lower_fence, upper_fence,
       (select min(l_extendedprice) from lineitem where l_extendedprice >= lower_fence) as whisker_low,
       (select max(l_extendedprice) from lineitem where l_extendedprice <= upper_fence) as whisker_high,
       (select count(*) from lineitem
        where l_extendedprice < lower_fence or l_extendedprice > upper_fence) as n_outliers,
       median - 1.58 * iqr / sqrt(n) as notch_low, median + 1.58 * iqr / sqrt(n) as notch_high
from f""", _BOX_COLS + ["notch_low", "notch_high"]))
def notch_stats(spark, d):
    return round_doubles(V.box_stats(Tables(spark, d).lineitem, "l_extendedprice", notch=True))


def _density_sql(n: int, by: str | None, bins: int) -> str:
    """Linear binning onto ``bins`` points, then the kernel sum on ``n`` grid points."""
    g = f"{by}, " if by else ""
    grp = f"group by {by}" if by else ""
    using = f"using ({by})" if by else "on true"
    last = bins - 1
    return f"""
with v as (select {g}value as x from events where value is not null),
s as (select {g}count(*) as n, min(x) as mn, max(x) as mx, stddev_samp(x) as sd,
             quantile_cont(x, 0.75) - quantile_cont(x, 0.25) as iqr from v {grp}),
b as (select {g}n, mn, mx, 0.9 * (case when least(sd, iqr / 1.34) > 0 then least(sd, iqr / 1.34)
                                   when sd > 0 then sd when abs(mn) > 0 then abs(mn) else 1.0 end)
             * pow(n::double, -0.2) as bw from s),
f as (select {g}case when mx - mn > 0 then (x - mn) / (mx - mn) * {last} else 0.0 end as g, mn, mx
      from v join s {using}),
l as (select {g}least(floor(g), {last - 1}) as lo, g - least(floor(g), {last - 1}) as frac, mn, mx from f),
p as (select {g}lo as i, 1.0 - frac as w, mn, mx from l
      union all select {g}lo + 1, frac, mn, mx from l),
w as (select {g}mn + i * (mx - mn) / {last} as x, sum(w) as c from p group by {g}i, mn, mx having sum(w) > 0),
k as (select {g}w.x, c, n, mn, mx, bw, i::int as idx,
             mn + i * (mx - mn) / {n - 1} as gx from w join b {using}, range({n}) r(i))
select {g}idx as "index", gx as x,
       sum(c * exp(-0.5 * ((gx - x) / bw) * ((gx - x) / bw))) / (n * bw * {math.sqrt(2 * math.pi)!r})
         as density, bw as bandwidth
from k group by {g}idx, gx, n, bw"""


@query("density_1d", ids=("VIZ6",), sql=sql_rounded(_density_sql(128, None, 512),
                                                    ["x", "density", "bandwidth"], 9))
def density_1d(spark, d):
    return round_doubles(V.density_1d(Tables(spark, d).events, "value", n=128), 9)


@query("violin_density", ids=("VIZ7",), sql=sql_rounded(_density_sql(64, "event_type", 512),
                                                        ["x", "density", "bandwidth"], 9))
def violin_density(spark, d):
    return round_doubles(V.density_1d(Tables(spark, d).events, "value", by=["event_type"], n=64), 9)


@query("density_binned", ids=("VIZ6",), sql=sql_rounded(_density_sql(128, None, 1024),
                                                        ["x", "density", "bandwidth"], 9))
def density_binned(spark, d):
    return round_doubles(V.density_1d(Tables(spark, d).events, "value", n=128, bins=1024), 9)


_DENSITY_2D_SQL = f"""
with v as (select l_quantity as x, l_discount as y from lineitem
           where l_quantity is not null and l_discount is not null),
s as (select count(*) as n, min(x) as xmn, max(x) as xmx, min(y) as ymn, max(y) as ymx,
             4 * 1.06 * least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34)
               * pow(count(*)::double, -0.2) / 4 as hx,
             4 * 1.06 * least(stddev_samp(y), (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / 1.34)
               * pow(count(*)::double, -0.2) / 4 as hy from v),
f as (select (x - xmn) / (xmx - xmn) * 127 as fx, (y - ymn) / (ymx - ymn) * 127 as fy from v, s),
l as (select least(floor(fx), 126) as i, fx - least(floor(fx), 126) as u,
             least(floor(fy), 126) as j, fy - least(floor(fy), 126) as w from f),
q as (select i, j, (1 - u) * (1 - w) as c from l union all select i + 1, j, u * (1 - w) from l
      union all select i, j + 1, (1 - u) * w from l union all select i + 1, j + 1, u * w from l),
p as (select xmn + i * (xmx - xmn) / 127 as x, ymn + j * (ymx - ymn) / 127 as y, c
      from (select i, j, sum(c) as c from q group by 1, 2 having sum(c) > 0), s),
g as (select i::int as i, j::int as j, xmn + i * (xmx - xmn) / 49 as gx,
             ymn + j * (ymx - ymn) / 49 as gy from s, range(50) a(i), range(50) b(j))
select i, j, gx as x, gy as y,
       sum(c * exp(-0.5 * ((gx - p.x) / hx) * ((gx - p.x) / hx))
             * exp(-0.5 * ((gy - p.y) / hy) * ((gy - p.y) / hy))) / (n * hx * hy * {2 * math.pi!r})
         as density
from g, p, s group by i, j, gx, gy, n, hx, hy"""


@query("density_2d", ids=("VIZ8", "JOIN4"), sql=sql_rounded(_DENSITY_2D_SQL, ["x", "y", "density"], 9))
def density_2d(spark, d):
    return round_doubles(V.density_2d(Tables(spark, d).lineitem, "l_quantity", "l_discount", n=50), 9)


# every cell's crossings in the order bottom, right, top, left; a saddle joins
# them around the corners that differ from its centre
_CONTOUR_SQL = """
with z as ({density}),
m as (select min(density) as lo, max(density) as hi from z),
u as (select *, (hi - lo) / {levels} as cell, pow(10, floor(log10((hi - lo) / {levels}))) as base from m),
k as (select lo, hi, base * case when 10 * base - cell < 1.5 * (cell - 5 * base) then 10
                                 when 5 * base - cell < 2.75 * (cell - 2 * base) then 5
                                 when 2 * base - cell < 1.5 * (cell - base) then 2 else 1 end as unit from u),
l as (select i * unit as level from k, range(0, 60) r(i)
      where i between floor(lo / unit + 1e-7) and ceil(hi / unit - 1e-7)),
c as (select a.i, a.j, a.x as xl, a.y as yl, d.x as xr, d.y as yu, a.density as z0, b.density as z1,
             d.density as z2, e.density as z3, level
      from z a join z b on b.i = a.i + 1 and b.j = a.j join z d on d.i = a.i + 1 and d.j = a.j + 1
               join z e on e.i = a.i and e.j = a.j + 1, l),
p as (select i, j, level, [z0 >= level, z1 >= level, z2 >= level, z3 >= level] as up,
             (z0 + z1 + z2 + z3) / 4 >= level as mid,
             [{{'x': xl + (level - z0) / (z1 - z0) * (xr - xl), 'y': yl}},
              {{'x': xr, 'y': yl + (level - z1) / (z2 - z1) * (yu - yl)}},
              {{'x': xl + (level - z3) / (z2 - z3) * (xr - xl), 'y': yu}},
              {{'x': xl, 'y': yl + (level - z0) / (z3 - z0) * (yu - yl)}}] as e from c),
q as (select *, list_filter([1, 2, 3, 4], lambda k: up[k] <> up[k % 4 + 1]) as cut from p),
s as (select i, j, level, unnest(case when len(cut) = 4 and up[1] = mid then [[1, 2], [3, 4]]
                                      when len(cut) = 4 then [[1, 4], [2, 3]] else [cut] end) as ends, e
      from q where len(cut) > 0)
select level, i, j, (ends[1] - 1)::int as edge0, (ends[2] - 1)::int as edge1, e[ends[1]].x as x0, e[ends[1]].y as y0,
       e[ends[2]].x as x1, e[ends[2]].y as y1 from s"""


@query("density_contours", ids=("VIZ8",), sql=sql_rounded(
    _CONTOUR_SQL.format(density=_DENSITY_2D_SQL, levels=10), ["level", "x0", "y0", "x1", "y1"], 6))
def density_contours(spark, d):
    out = V.density_contours(Tables(spark, d).lineitem, "l_quantity", "l_discount", n=50, levels=10)
    return round_doubles(out, 6)


@query("mosaic_cells", ids=("VIZ2",), sql=sql_rounded("""
with c as (select o_orderpriority, o_orderstatus, count(*) as count from orders group by 1, 2),
b as (select *, sum(count) over (partition by o_orderpriority) as own, sum(count) over () as total,
             sum(count) over (partition by o_orderpriority order by o_orderstatus) as upto from c),
x as (select o_orderpriority, sum(own) over (order by o_orderpriority) as right_edge
      from (select distinct o_orderpriority, own from b))
select o_orderpriority, o_orderstatus, count, (right_edge - own) / total as x0, right_edge / total as x1,
       (upto - count) / own as y0, upto / own as y1
from b join x using (o_orderpriority)""", ["x0", "x1", "y0", "y1"], 9))
def mosaic_cells(spark, d):
    return round_doubles(V.mosaic_cells(Tables(spark, d).orders, "o_orderpriority", "o_orderstatus"), 9)


@query("mosaic_facets", ids=("VIZ2",), sql=sql_rounded("""
with c as (select o_orderstatus, o_orderpriority, year(o_orderdate)::int as year, count(*) as count
           from orders group by 1, 2, 3),
b as (select *, sum(count) over (partition by o_orderstatus, o_orderpriority) as own,
             sum(count) over (partition by o_orderstatus) as total,
             sum(count) over (partition by o_orderstatus, o_orderpriority order by year) as upto from c),
x as (select o_orderstatus, o_orderpriority,
             sum(own) over (partition by o_orderstatus order by o_orderpriority) as right_edge
      from (select distinct o_orderstatus, o_orderpriority, own from b))
select o_orderstatus, o_orderpriority, year, count, (right_edge - own) / total as x0,
       right_edge / total as x1, (upto - count) / own as y0, upto / own as y1
from b join x using (o_orderstatus, o_orderpriority)""", ["x0", "x1", "y0", "y1"], 9))
def mosaic_facets(spark, d):
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    return round_doubles(V.mosaic_cells(o, "o_orderpriority", "year", ["o_orderstatus"]), 9)


# bins one after another: each starts at the first value beyond the one before
_DOT_SQL = """
with recursive v as (select {keys} as g, value as x, count(*) as c from events where value is not null group by all),
b as (select g, min(x) as start from v group by g
      union all
      select b.g, (select min(x) from v where v.g = b.g and x >= b.start + {width} + 1e-8) as start
      from b where b.start is not null),
s as (select g, start, lead(start) over (partition by g order by start) as stop from b where start is not null)
select {out} min(x) as low, max(x) as high, sum(c)::bigint as count, (min(x) + max(x)) / 2 as center
from v join s on v.g = s.g and x >= start and (stop is null or x < stop) group by s.g, start"""


@query("dotplot_density", ids=("VIZ3",), sql=sql_rounded(
    _DOT_SQL.format(keys="0", out="", width="5.0"), ["low", "high", "center"], 9))
def dotplot_density(spark, d):
    return round_doubles(V.dotplot_density(Tables(spark, d).events, "value", 5.0), 9)


@query("dotplot_density_groups", ids=("VIZ3",), sql=sql_rounded(
    _DOT_SQL.format(keys="event_type", out="s.g as event_type,", width="2.5"), ["low", "high", "center"], 9))
def dotplot_density_groups(spark, d):
    return round_doubles(V.dotplot_density(Tables(spark, d).events, "value", 2.5, ["event_type"]), 9)


_BIN2D_SQL = """
with s as (select min(l_quantity) as xmn, max(l_quantity) as xmx,
                  min(l_extendedprice) as ymn, max(l_extendedprice) as ymx from lineitem),
b as (select case when (xmx - xmn) / 30 = 0 then 0
                  else least(floor((l_quantity - xmn) / ((xmx - xmn) / 30)), 29) end::bigint as x_bin,
             case when (ymx - ymn) / 30 = 0 then 0
                  else least(floor((l_extendedprice - ymn) / ((ymx - ymn) / 30)), 29) end::bigint as y_bin,
             xmn, xmx, ymn, ymx
      from lineitem, s)
select x_bin, y_bin, xmn + (x_bin + 0.5) * ((xmx - xmn) / 30) as x_center,
       ymn + (y_bin + 0.5) * ((ymx - ymn) / 30) as y_center, count(*) as count
from b group by x_bin, y_bin, xmn, xmx, ymn, ymx"""


@query("bin2d", ids=("VIZ9",), sql=sql_rounded(_BIN2D_SQL, ["x_center", "y_center"], 9))
def bin2d(spark, d):
    return round_doubles(V.bin2d(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", 30), 9)


def _hexbin_sql(where: str) -> str:
    s3 = repr(math.sqrt(3.0))
    return f"""
with s as (select min(l_quantity) as xmn, max(l_quantity) as xmx,
                  min(l_extendedprice) as ymn, max(l_extendedprice) as ymx from lineitem),
t as (select xmn, ymn, (xmx - xmn) / 30 as dx, (ymx - ymn) / 30 as dy,
             (l_quantity - xmn) / ((xmx - xmn) / 30) as sx,
             (l_extendedprice - ymn) / (((ymx - ymn) / 30) * {s3}) as sy
      from lineitem, s where {where}),
c as (select *, floor(sx + 0.5)::double as i1, floor(sy + 0.5)::double as j1,
             floor(sx)::double + 0.5 as i2, floor(sy)::double + 0.5 as j2 from t),
e as (select *, (sx - i1) * (sx - i1) + 3.0 * ((sy - j1) * (sy - j1)) as d1,
             (sx - i2) * (sx - i2) + 3.0 * ((sy - j2) * (sy - j2)) as d2 from c),
h as (select case when d1 <= d2 then i1 else i2 end as hex_i,
             case when d1 <= d2 then j1 else j2 end as hex_j, xmn, ymn, dx, dy from e)
select hex_i, hex_j, xmn + hex_i * dx as x_center, ymn + hex_j * dy * {s3} as y_center,
       count(*) as count
from h group by hex_i, hex_j, xmn, ymn, dx, dy"""


@query("hexbin", ids=("VIZ10",), sql=sql_rounded(_hexbin_sql("true"), ["x_center", "y_center"], 9))
def hexbin(spark, d):
    return round_doubles(V.hexbin(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", 30), 9)


@query("hexbin_subset", ids=("VIZ10",), sql=sql_rounded(_hexbin_sql("l_returnflag = 'R'"),
                                                        ["x_center", "y_center"], 9))
def hexbin_subset(spark, d):
    out = V.hexbin(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", 30,
                   where=F.col("l_returnflag") == "R")
    return round_doubles(out, 9)


# Student's quantile around the normal one, in powers of 1/df
_Z = 1.959963984540054
_T_SQL = " + ".join(f"({g!r}) / pow({{0}}, {k})" for k, g in enumerate((
    _Z, (_Z**3 + _Z) / 4, (5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96,
    (3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384)))
_BAND_SQL = """
with r as (select {keys}, regr_count(l_extendedprice, l_quantity) as n,
                  regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a,
                  regr_avgx(l_extendedprice, l_quantity) as m, regr_sxx(l_extendedprice, l_quantity) as sxx,
                  regr_syy(l_extendedprice, l_quantity) as syy, regr_sxy(l_extendedprice, l_quantity) as sxy,
                  min(l_quantity) as mn, max(l_quantity) as mx from lineitem group by all),
g as (select *, i::int as idx, mn + i * (mx - mn) / 19 as gx from r, range(20) t(i)),
h as (select *, a + b * gx as fit,
             {t} * sqrt((syy - b * sxy) / (n - 2) * (1.0 / n + (gx - m) * (gx - m) / sxx)) as half from g)
select {keys}, idx as "index", gx as x, fit, fit - half as lower, fit + half as upper from h"""
_BAND = ["x", "fit", "lower", "upper"]


@query("lm_band", ids=("VIZ11",), sql=sql_rounded(
    _BAND_SQL.format(keys="l_returnflag", t=f"({_T_SQL.format('(n - 2)::double')})"), _BAND, 4))
def lm_band(spark, d):
    # hundreds of degrees of freedom and more: SQL has the expansion
    out = V.lm_band(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"], points=20)
    return round_doubles(out, 4)


@query("lm_band_small", ids=("VIZ11",), sql=sql_rounded("""
with s as (select regionkey, count(*) over (partition by regionkey) as k, x, y from (
             select n_regionkey as regionkey, n_nationkey::double as x, count(*)::double as y
             from nation join customer on c_nationkey = n_nationkey group by 1, 2)),
r as (select regionkey, regr_count(y, x) as n, regr_slope(y, x) as b, regr_intercept(y, x) as a,
             regr_avgx(y, x) as m, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy, regr_sxy(y, x) as sxy,
             min(x) as mn, max(x) as mx from s group by 1),
t(df, q) as (values (1, 12.706204736432095), (2, 4.302652729911275), (3, 3.182446305284263),
                    (4, 2.7764451051977987), (5, 2.570581835636314), (6, 2.4469118511449692)),
g as (select *, i::int as idx, mn + i * (mx - mn) / 9 as gx from r, range(10) u(i)),
h as (select g.*, a + b * gx as fit,
             q * sqrt(greatest(syy - b * sxy, 0) / (n - 2) * (1.0 / n + (gx - m) * (gx - m) / sxx)) as half
      from g left join t on df = n - 2)
select regionkey, idx as "index", gx as x, fit, fit - half as lower, fit + half as upper from h""", _BAND, 6))
def lm_band_small(spark, d):
    # a handful of nations in each region: few degrees of freedom, tabulated in SQL
    t = Tables(spark, d)
    n, c = t.nation, t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("y"))
    rows = n.join(c, n["n_nationkey"] == c["c_nationkey"]).select(
        F.col("n_regionkey").alias("regionkey"), F.col("n_nationkey").cast("double").alias("x"), "y")
    return round_doubles(V.lm_band(rows, "x", "y", ["regionkey"], points=10), 6)


@query("lm_line", ids=("VIZ11",), sql="""
select l_returnflag, regr_count(l_extendedprice, l_quantity)::bigint as n,
       round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
       round(regr_r2(l_extendedprice, l_quantity), 9) as r2,
       round(regr_avgx(l_extendedprice, l_quantity), 9) as mean_x,
       round(regr_sxx(l_extendedprice, l_quantity), 3) as sxx,
       round(regr_syy(l_extendedprice, l_quantity) / 1e6, 3) as syy,
       round(regr_sxy(l_extendedprice, l_quantity), 2) as sxy
from lineitem group by 1""")
def lm_line(spark, d):
    out = V.lm_line(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", F.col("n").cast("long").alias("n"),
                      rnd("slope", 6).alias("slope"), rnd("intercept", 4).alias("intercept"),
                      rnd("r2", 9).alias("r2"), rnd("mean_x", 9).alias("mean_x"),
                      rnd("sxx", 3).alias("sxx"), rnd(F.col("syy") / 1e6, 3).alias("syy"),
                      rnd("sxy", 2).alias("sxy"))


@query("group_mean_bars", ids=("VIZ12", "AGG4"), sql=sql_rounded("""
select l_returnflag, l_linestatus, avg(l_quantity) as l_quantity_avg,
       avg(l_extendedprice) as l_extendedprice_avg, avg(l_discount) as l_discount_avg
from lineitem group by 1, 2""", ["l_quantity_avg", "l_extendedprice_avg", "l_discount_avg"]))
def group_mean_bars(spark, d):
    out = V.group_means(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"],
                        ["l_quantity", "l_extendedprice", "l_discount"])
    return round_doubles(out)


@query("heat_mean", ids=("VIZ13", "AGG16"), headline=True, sql="""
select o_orderstatus, o_orderpriority, round(avg(o_totalprice), 2) as o_totalprice_avg
from orders group by 1, 2""")
def heat_mean(spark, d):
    out = V.group_means(Tables(spark, d).orders, ["o_orderstatus", "o_orderpriority"], ["o_totalprice"])
    return out.withColumn("o_totalprice_avg", rnd("o_totalprice_avg", 2))


@query("line_series", ids=("VIZ14",), sql="""
select o_orderstatus, year(o_orderdate)::int as year, round(avg(o_totalprice), 4) as o_totalprice
from orders group by 1, 2 order by 1, 2""")
def line_series(spark, d):
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    out = V.line_series(o, ["o_orderstatus"], "year", "o_totalprice")
    return out.withColumn("o_totalprice", rnd("o_totalprice", 4))


@query("stacked_area", ids=("VIZ15",), sql="""
with a as (select year(o_orderdate)::int as year, o_orderpriority, count(*) as n
           from orders group by 1, 2)
select year, o_orderpriority, n,
       sum(n) over (partition by year order by o_orderpriority
                    rows between unbounded preceding and current row)::bigint as ymax,
       (sum(n) over (partition by year order by o_orderpriority
                     rows between unbounded preceding and current row) - n)::bigint as ymin
from a""")
def stacked_area(spark, d):
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    agg = o.groupBy("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return V.stacked_area(agg, "year", "o_orderpriority", "n")


@query("scatter_points", ids=("VIZ16",), sql="""
select l_quantity, l_extendedprice, l_returnflag from lineitem""")
def scatter_points(spark, d):
    return V.scatter_points(Tables(spark, d).lineitem, ["l_quantity", "l_extendedprice", "l_returnflag"])


@query("scatter_sample", ids=("VIZ16",), sql="""
select l_quantity, l_extendedprice, l_returnflag from lineitem where l_orderkey % 10 = 0""")
def scatter_sample(spark, d):
    # every tenth order's points, by arithmetic on the key
    return V.scatter_points(Tables(spark, d).lineitem, ["l_quantity", "l_extendedprice", "l_returnflag"],
                            every=10, key="l_orderkey")


@query("corr_heat", ids=("VIZ17", "STA5"), sql="""
with c as (select corr(l_quantity, l_extendedprice) as qp, corr(l_quantity, l_discount) as qd,
                  corr(l_extendedprice, l_discount) as pd from lineitem),
m as (select 'l_quantity' as var1, 'l_quantity' as var2, 1.0 as value from c
      union all select 'l_quantity', 'l_extendedprice', qp from c
      union all select 'l_quantity', 'l_discount', qd from c
      union all select 'l_extendedprice', 'l_quantity', qp from c
      union all select 'l_extendedprice', 'l_extendedprice', 1.0 from c
      union all select 'l_extendedprice', 'l_discount', pd from c
      union all select 'l_discount', 'l_quantity', qd from c
      union all select 'l_discount', 'l_extendedprice', pd from c
      union all select 'l_discount', 'l_discount', 1.0 from c)
select var1, var2, round(value, 9)::double as value from m""")
def corr_heat(spark, d):
    return S.corr_matrix(Tables(spark, d).lineitem, ["l_quantity", "l_extendedprice", "l_discount"],
                         digits=9)


@query("pair_matrix", ids=("VIZ18",), sql=sql_rounded("""
with h as (select greatest(0, ceil(10 * ((l_quantity - mn) / (mx - mn))) - 1)::int as bin
           from lineitem, (select min(l_quantity) mn, max(l_quantity) mx from lineitem) s),
h2 as (select greatest(0, ceil(10 * ((l_discount - mn) / (mx - mn))) - 1)::int as bin
       from lineitem, (select min(l_discount) mn, max(l_discount) mx from lineitem) s),
hh as (select 'l_quantity' as var1, 'l_quantity' as var2, 'hist' as kind, b.bin, count(h.bin) as c
       from range(10) b(bin) left join h on h.bin = b.bin group by b.bin
       union all
       select 'l_discount', 'l_discount', 'hist', b.bin, count(h2.bin)
       from range(10) b(bin) left join h2 on h2.bin = b.bin group by b.bin)
select 'l_quantity' as var1, 'l_discount' as var2, 'corr' as kind, null::varchar as level1,
       null::varchar as level2, corr(l_quantity, l_discount) as value from lineitem
union all select 'l_discount', 'l_quantity', 'corr', null, null, corr(l_quantity, l_discount)
       from lineitem
union all select var1, var2, kind, bin::varchar, null, c::double from hh
union all select 'l_returnflag', 'l_returnflag', 'count', l_returnflag, null, count(*)::double
       from lineitem group by l_returnflag
union all select 'l_returnflag', 'l_linestatus', 'count', l_returnflag, l_linestatus,
       count(*)::double from lineitem group by l_returnflag, l_linestatus
union all select 'l_linestatus', 'l_linestatus', 'count', l_linestatus, null, count(*)::double
       from lineitem group by l_linestatus
union all select v, c, k, null, lvl, q from (
  select 'l_quantity' as v, 'l_returnflag' as c, l_returnflag as lvl,
         unnest(['q1', 'median', 'q3']) as k,
         unnest(quantile_cont(l_quantity, [0.25, 0.5, 0.75])) as q from lineitem group by l_returnflag
  union all
  select 'l_discount', 'l_returnflag', l_returnflag, unnest(['q1', 'median', 'q3']),
         unnest(quantile_cont(l_discount, [0.25, 0.5, 0.75])) from lineitem group by l_returnflag
  union all
  select 'l_quantity', 'l_linestatus', l_linestatus, unnest(['q1', 'median', 'q3']),
         unnest(quantile_cont(l_quantity, [0.25, 0.5, 0.75])) from lineitem group by l_linestatus
  union all
  select 'l_discount', 'l_linestatus', l_linestatus, unnest(['q1', 'median', 'q3']),
         unnest(quantile_cont(l_discount, [0.25, 0.5, 0.75])) from lineitem group by l_linestatus)
""", ["value"], 9))
def pair_matrix(spark, d):
    out = V.pair_matrix(Tables(spark, d).lineitem, ["l_quantity", "l_discount"],
                        ["l_returnflag", "l_linestatus"])
    return round_doubles(out, 9)


@query("bucket_means", ids=("VIZ19", "FN6", "JOIN1", "AGG16"), headline=True, sql="""
with j as (select l_quantity, l_extendedprice, c_mktsegment
           from customer join orders on c_custkey = o_custkey
           join lineitem on l_orderkey = o_orderkey),
b as (select c_mktsegment, l_extendedprice,
             case when l_quantity is null then null when l_quantity < 30 then '<30'
                  when l_quantity < 41 then '30-40' when l_quantity < 51 then '41-50'
                  when l_quantity < 61 then '51-60' when l_quantity < 71 then '61-70'
                  else '>70' end as range from j)
select range, c_mktsegment, round(avg(l_extendedprice), 6) as l_extendedprice_avg,
       count(*) as n,
       case range when '<30' then 0 when '30-40' then 1 when '41-50' then 2
                  when '51-60' then 3 when '61-70' then 4 when '>70' then 5 end as range_order
from b group by 1, 2""")
def bucket_means(spark, d):
    t = Tables(spark, d)
    # the two smaller tables are joined first, so the lineitem-sized side is
    # shuffled once (on the order key) instead of twice
    cust = t.customer.select("c_custkey", "c_mktsegment")
    orders = t.orders.select("o_orderkey", "o_custkey")
    order_seg = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "c_mktsegment")
    # lineitem is the fact table: never broadcast it, whatever its estimated
    # size after projection; a sort-merge join on the order key scales
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice").hint("merge")
    j = li.join(order_seg, li.l_orderkey == order_seg.o_orderkey)
    out = V.bucket_means(j, "l_quantity", "l_extendedprice", by=["c_mktsegment"])
    return out.withColumn("l_extendedprice_avg", rnd("l_extendedprice_avg", 6))
