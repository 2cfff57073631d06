"""Tables derived from the driver tables for the recipes that need features
the generated data lacks (NULL / NaN / empty text, tables with different
columns), each with its SQL twin for the oracle.

The rules are deterministic functions of the key, applied to *every* row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.plans.registry import Tables


def orders_with_gaps(t: Tables) -> DataFrame:
    """orders with missing values injected by rule:

    * ``o_orderstatus``: NULL when key % 7 = 0, ``""`` when key % 11 = 0
    * ``o_orderpriority``: NULL when key % 5 = 0
    * ``o_totalprice``: NaN when key % 13 = 0, NULL when key % 17 = 0
    """
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 11 == 0, F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 13 == 0, F.lit(float("nan")))
         .when(k % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
    )


GAPS_SQL = """
with og as (
  select o_orderkey, o_custkey,
         case when o_orderkey % 7 = 0 then null
              when o_orderkey % 11 = 0 then '' else o_orderstatus end as o_orderstatus,
         case when o_orderkey % 5 = 0 then null else o_orderpriority end as o_orderpriority,
         case when o_orderkey % 13 = 0 then 'NaN'::double
              when o_orderkey % 17 = 0 then null else o_totalprice end as o_totalprice,
         o_orderdate
  from orders)
"""


def customers_as_parties(t: Tables) -> DataFrame:
    """customer with neutral names: name, nationkey, acctbal, segment."""
    return t.customer.select(F.col("c_name").alias("name"),
                             F.col("c_nationkey").alias("nationkey"),
                             F.col("c_acctbal").alias("acctbal"),
                             F.col("c_mktsegment").alias("segment"))


def suppliers_as_parties(t: Tables) -> DataFrame:
    """supplier with neutral names: name, nationkey, acctbal (no segment)."""
    return t.supplier.select(F.col("s_name").alias("name"),
                             F.col("s_nationkey").alias("nationkey"),
                             F.col("s_acctbal").alias("acctbal"))


PARTIES_SQL = """
with cu as (select c_name as name, c_nationkey as nationkey, c_acctbal as acctbal,
                   c_mktsegment as segment from customer),
     su as (select s_name as name, s_nationkey as nationkey, s_acctbal as acctbal from supplier)
"""
