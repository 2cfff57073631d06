"""Compare a registered query with its SQL twin run by DuckDB.

Used by the tests and by ``tools/oracle_check.py``.  Rows are compared as
multisets of normalised tuples with columns sorted by name (the same shape
of check as the external correctness gate).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tabula.plans.registry import TABLES


def normalise(v, digits: int = 6) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, digits) + 0.0:.{digits}f}"
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T", " ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(normalise(x, digits) for x in v) + "]"
    return str(v)


def canonical(columns: list[str], records: list[tuple], digits: int = 6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    rows = sorted(tuple(normalise(rec[i], digits) for i in order) for rec in records)
    return cols, rows


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


@dataclass
class Outcome:
    ok: bool
    detail: str
    n_rows: int


# Spark simple type names and the DuckDB type each must come out as
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
             "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
             "boolean": "BOOLEAN", "array<double>": "DOUBLE[]"}


def compare(df: DataFrame, sql: str, con, digits: int = 6) -> Outcome:
    srecs = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    drecs = rel.fetchall()
    sc, sr = canonical(df.columns, srecs, digits)
    dc, dr = canonical(list(rel.columns), drecs, digits)
    if sc != dc:
        return Outcome(False, f"columns differ: spark={sc} sql={dc}", len(sr))
    sql_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    wrong = [(c, t, sql_types[c]) for c, t in df.dtypes if SQL_TYPES.get(t, t) != sql_types[c]]
    if wrong:
        return Outcome(False, f"types differ (column, spark, sql): {wrong}", len(sr))
    if len(sr) != len(dr):
        return Outcome(False, f"row counts differ: spark={len(sr)} sql={len(dr)}", len(sr))
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return Outcome(False, f"values differ, e.g. {diff}", len(sr))
    return Outcome(True, "", len(sr))
