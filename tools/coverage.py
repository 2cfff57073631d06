"""Map every operator ID of the survey to library functions and registered queries.

    python tools/coverage.py > COVERAGE.md

Library functions are found by the IDs their docstrings start with
(a docstring starting "STA8: ..."); queries by the ``ids`` they are registered with.
"""

from __future__ import annotations

import importlib
import inspect
import os
import pkgutil
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

ID = re.compile(r"\b([A-Z]{2,4})(\d+)\b")
GROUPS = ["SRC", "SNK", "ACT", "PRJ", "FLT", "NA", "JOIN", "AGG", "STA", "SRT", "SET", "FN",
          "UDF", "SQL", "MLR", "VIZ"]


def _expand(text: str) -> set[str]:
    """IDs named in a docstring head, with ranges like ``AGG7-AGG11``."""
    out = set()
    for m in re.finditer(r"\b([A-Z]{2,4})(\d+)(?:-(?:\1)?(\d+))?", text):
        pre, a, b = m.group(1), int(m.group(2)), m.group(3)
        if pre not in GROUPS:
            continue
        for i in range(a, int(b) + 1 if b else a + 1):
            out.add(f"{pre}{i}")
    return out


# operators that are single Spark built-ins, used directly by the queries
BUILTIN = {
    "PRJ1": "`DataFrame.select`", "PRJ2": "`DataFrame.select` + column expressions",
    "PRJ12": "`functions.lit`", "FLT1": "`DataFrame.where` with comparisons",
    "FLT2": "`&` / `|` on columns", "FLT3": "`DataFrame.where(sql_text)`",
    "FLT4": "`df[condition]`", "FLT6": "`Column.isNull` / `isNotNull`",
    "FLT9": "`between` / SQL range predicate", "FN2": "`functions.abs`",
    "FN3": "`functions.ceil` / `floor`", "FN4": "`functions.round`",
    "SQL1": "`DataFrame.createOrReplaceTempView`", "SQL2": "`SparkSession.sql(text, args)`",
    "MLR1": "`pyspark.ml.feature.RFormula` (inside every `models.fit_*`)",
    "ACT8": "`DataFrame.repartition` (inside `sources.files.write_partitioned`)",
}


def main() -> None:
    import tabula
    from tabula.plans.catalog import all_queries

    funcs: dict[str, list[str]] = defaultdict(list)
    for mod in pkgutil.walk_packages(tabula.__path__, "tabula."):
        if mod.name.startswith("tabula.llm"):
            continue
        if ".plans." in mod.name and not mod.name.endswith("strategy"):
            continue
        m = importlib.import_module(mod.name)
        for name, obj in inspect.getmembers(m, inspect.isfunction):
            if obj.__module__ != m.__name__ or name.startswith("_"):
                continue
            head = (inspect.getdoc(obj) or "").split(":")[0]
            for i in _expand(head):
                funcs[i].append(f"`{mod.name.removeprefix('tabula.')}.{name}`")
    queries: dict[str, list[str]] = defaultdict(list)
    sql = {}
    for q in all_queries().values():
        for i in q.ids:
            queries[i].append(q.name)
        sql[q.name] = q.sql is not None
    ids = sorted(set(funcs) | set(queries),
                 key=lambda s: (GROUPS.index(ID.match(s).group(1)), int(ID.match(s).group(2))))
    print("# Coverage of the survey's operator inventory\n")
    print("Generated by `python tools/coverage.py`. Queries marked * have no SQL oracle "
          "(rows-only check).\n")
    print("| ID | library functions | registered queries |")
    print("| --- | --- | --- |")
    for i in ids:
        qs = ", ".join(f"{q}{'' if sql[q] else '*'}" for q in sorted(queries.get(i, [])))
        lib = ", ".join(sorted(set(funcs.get(i, [])))) or BUILTIN.get(i, "—")
        print(f"| {i} | {lib} | {qs or '—'} |")
    print("\nNot registered as queries: SRC5 (Avro needs the external spark-avro package, "
          "absent here; `sources.files.read_avro` is provided).")


if __name__ == "__main__":
    main()
