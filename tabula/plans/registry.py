"""Registry of named queries: each operator group registers example queries
over the driver tables together with an independent SQL formulation that
DuckDB can run (the correctness oracle).

A query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the given
tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)
    headline: bool = False


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ids: tuple[str, ...] = (),
          headline: bool = False):
    """Register ``fn`` under ``name`` with its oracle SQL (``None`` = no SQL form)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"duplicate query name {name}")
        REGISTRY[name] = Query(name, fn, zero_safe_rounding(sql) if sql else None,
                               tuple(ids), headline)
        return fn
    return deco


def zero_safe_rounding(sql: str) -> str:
    """Rewrite each two-argument ``round(x, d)`` in oracle SQL as ``(round(x, d) + 0.0)``.

    Rounding a small negative number gives -0.0 in DuckDB; adding 0.0 turns it
    into 0.0, as :func:`rnd` does on the Spark side.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        if comma is None:
            out.append(sql[i:k])
            i = k
            continue
        arg = zero_safe_rounding(sql[j + 6:comma])
        out.append(sql[i:j])
        out.append(f"(round({arg},{sql[comma + 1:k - 1]}) + 0.0)")
        i = k


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy access to the driver tables: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def rnd(col: str | Column, digits: int = 6) -> Column:
    """Round a floating column for comparison with the oracle.

    Half away from zero on the scaled binary value (``round(x·10^d)/10^d``),
    the way SQL engines round doubles; Spark's ``round`` rounds the exact
    binary expansion instead, which differs on decimal halves such as
    ``…86975``.  ``+ 0.0`` normalises -0.0.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    p = F.lit(10.0 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * p + F.lit(0.5)) / p + F.lit(0.0)


def round_doubles(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Round every double column (or those in ``only``) for the oracle compare."""
    targets = [f.name for f in df.schema.fields
               if f.dataType.typeName() == "double" and (only is None or f.name in only)]
    return df.withColumns({c: rnd(c, digits) for c in targets})


def sql_rounded(inner: str, cols: list[str], digits: int = 6) -> str:
    """Wrap oracle SQL so the named columns are rounded like :func:`round_doubles`."""
    repl = ", ".join(f'round("{c}", {digits}) as "{c}"' for c in cols)
    return f"select * replace ({repl}) from ({inner}) _r"
