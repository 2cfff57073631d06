"""Step 10 queries: file formats (SRC1-SRC8, SNK1-SNK3).

Each query writes Spark-derived data to a new folder below the shared
``spark.checkpoint.dir``, reads it back with the reader under test and
returns what was read, so the content is checked against SQL on the source.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F

from tabula.functions.scalar import RANGE_BUCKETS, range_bucket
from tabula.plans.derived import (GAPS_SQL, PARTIES_SQL, customers_as_parties,
                                  orders_with_gaps, suppliers_as_parties)
from tabula.plans.registry import Tables, query, rnd
from tabula.plans.strategy import attach_scalars
from tabula.session import scratch_path
from tabula.sources import files as IO


@query("parquet_roundtrip", ids=("SNK1", "SNK2", "SRC8"), sql="""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders""")
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "orders-parquet")
    IO.write_table(Tables(spark, d).orders, path, "parquet", mode="overwrite")
    return IO.read_parquet(spark, path)


@query("replace_own_source", ids=("SNK1",), sql="""
select o_orderstatus, count(*) as n, round(sum(o_totalprice * 1.1), 2) as total
from orders where o_orderstatus <> 'F' group by 1""")
def replace_own_source(spark, d):
    # the table is replaced by a result that is read from it, twice
    path = scratch_path(spark, "orders-replaced")
    IO.write_table(Tables(spark, d).orders, path, "parquet")
    IO.replace_table(IO.read_parquet(spark, path).where("o_orderstatus <> 'F'"), path)
    IO.replace_table(IO.read_parquet(spark, path).withColumn("o_totalprice", F.col("o_totalprice") * 1.1), path)
    return IO.read_parquet(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query("json_roundtrip", ids=("SRC2", "SNK1"), sql="""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders""")
def json_roundtrip(spark, d):
    orders = Tables(spark, d).orders
    path = scratch_path(spark, "orders-json")
    IO.write_table(orders, path, "json")
    return IO.read_json(spark, path, schema=orders.schema)


@query("json_multi", ids=("SRC3",), sql=PARTIES_SQL + """
select acctbal, name, nationkey, segment from cu
union all select acctbal, name, nationkey, null from su""")
def json_multi(spark, d):
    t = Tables(spark, d)
    a, b = scratch_path(spark, "customers-json"), scratch_path(spark, "suppliers-json")
    IO.write_table(customers_as_parties(t), a, "json")
    IO.write_table(suppliers_as_parties(t), b, "json")
    # two paths, one table: the inferred schema is the union of the fields
    got = IO.read_json(spark, [a, b])
    return got.select(F.col("acctbal").cast("double"), "name",
                      F.col("nationkey").cast("int"), "segment")


@query("csv_null_marker", ids=("SRC4",), sql=GAPS_SQL + """
select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate
from og""")
def csv_null_marker(spark, d):
    g = orders_with_gaps(Tables(spark, d))
    path = scratch_path(spark, "orders-csv")
    IO.write_table(g, path, "csv", header=True, nullValue="NA", emptyValue='""')
    got = IO.read_csv(spark, path, header=True, infer_schema=True, null_value="NA")
    return got.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"),
                      "o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("double"),
                      F.col("o_orderdate").cast("timestamp_ntz"))


@query("blank_as_null", ids=("SRC6",), sql=GAPS_SQL + """
select o_orderkey, nullif(o_orderstatus, '') as o_orderstatus, o_orderpriority from og""")
def blank_as_null(spark, d):
    g = orders_with_gaps(Tables(spark, d)).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "orders-gaps-parquet")
    IO.write_table(g, path, "parquet")
    return IO.blank_as_null(IO.read_parquet(spark, path), ["o_orderstatus"])


@query("libsvm_roundtrip", ids=("SRC7",), sql="""
select (l_quantity > 25)::int::double as label, count(*) as n,
       round(sum(l_quantity), 2) as sum_f0, round(sum(l_discount), 2) as sum_f1
from lineitem group by 1""")
def libsvm_roundtrip(spark, d):
    li = Tables(spark, d).lineitem
    feats = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features") \
        .transform(li.withColumn("label", (F.col("l_quantity") > 25).cast("double"))) \
        .select("label", "features")
    path = scratch_path(spark, "lineitem-libsvm")
    IO.write_table(feats, path, "libsvm")
    got = IO.read_libsvm(spark, path, num_features=2)
    assert isinstance(got.schema["features"].dataType, VectorUDT)
    v = vector_to_array("features")
    return got.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                    rnd(F.sum(v[0]), 2).alias("sum_f0"),
                                    rnd(F.sum(v[1]), 2).alias("sum_f1"))


@query("partitioned_export", ids=("SNK3", "ACT8"), sql="""
select c_custkey, c_name, c_mktsegment, c_acctbal, 6::bigint as n_files from customer""")
def partitioned_export(spark, d):
    cust = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "customer-csv")
    IO.write_partitioned(cust, path, 6, "csv", header=True)
    got = IO.read_csv(spark, path, header=True, schema=cust.schema)
    files = got.select(F.input_file_name().alias("file")).agg(F.count_distinct("file").alias("n_files"))
    return attach_scalars(got, files)


@query("local_frame", ids=("SRC1",), sql="""
with b as (select case when l_quantity < 30 then '<30' when l_quantity < 41 then '30-40'
                       when l_quantity < 51 then '41-50' when l_quantity < 61 then '51-60'
                       when l_quantity < 71 then '61-70' else '>70' end as label
           from lineitem where l_quantity is not null)
select label, case label when '<30' then 0 when '30-40' then 1 when '41-50' then 2
                         when '51-60' then 3 when '61-70' then 4 else 5 end as range_order,
       count(*) as n
from b group by label""")
def local_frame(spark, d):
    # a local lookup table (the fixed range labels) made distributed and
    # joined, broadcast, to counts that Spark computes from lineitem
    lookup = IO.from_local(spark, [(label, order) for label, order, _, _ in RANGE_BUCKETS],
                           "label string, range_order int")
    counts = Tables(spark, d).lineitem.where(F.col("l_quantity").isNotNull()) \
        .groupBy(range_bucket("l_quantity").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(lookup), "label").select("label", "range_order", "n")
