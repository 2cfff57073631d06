"""Scalar column expressions (FN1-FN6, FN17, PRJ11-PRJ12).

All helpers return ``Column`` objects built from ``pyspark.sql.functions``,
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_cast(col: str | Column, to: str) -> Column:
    """PRJ11: cast that yields NULL on bad input (old non-ANSI behaviour).

    Spark 4 runs with ANSI mode on, where a plain ``cast`` raises on bad text;
    the recipes were written for the NULL-on-failure behaviour.
    """
    return _c(col).try_cast(to)


def if_else(cond: Column, yes, no) -> Column:
    """FN5: ``ifelse(cond, yes, no)``; a NULL condition takes the ``no`` branch."""
    return F.when(cond, yes).otherwise(no)


def case_chain(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """FN6: first matching branch wins, written as ``coalesce(when(...), ..., lit)``.

    Equivalent to a ``CASE WHEN`` chain; Catalyst folds both to the same
    expression.
    """
    parts = [F.when(cond, F.lit(val) if not isinstance(val, Column) else val)
             for cond, val in branches]
    if default is not None:
        parts.append(F.lit(default) if not isinstance(default, Column) else default)
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


# The score ranges of the range-bucket recipe, in order, with
# their labels and order index.  Bounds are inclusive whole numbers.
RANGE_BUCKETS = [
    ("<30", 0, None, 29),
    ("30-40", 1, 30, 40),
    ("41-50", 2, 41, 50),
    ("51-60", 3, 51, 60),
    ("61-70", 4, 61, 70),
    (">70", 5, 71, 80),
]


def range_bucket(col: str | Column, mode: str = "gapfree") -> Column:
    """FN6/VIZ19: label of the score range a value falls in.

    ``mode="faithful"`` reproduces the recipe exactly: whole-number bounds
    tested with ``>=``/``<=``, so values between bounds (40.5), above 80, and
    NULL all fall to the default label ``"<30"``.

    ``mode="gapfree"`` (default) uses half-open ranges ``[30,41) [41,51)
    [51,61) [61,71) [71,inf)``, below 30 is ``"<30"`` and NULL stays NULL.
    """
    v = _c(col)
    if mode == "faithful":
        branches = [((v >= lo) & (v <= hi), label)
                    for label, _, lo, hi in RANGE_BUCKETS if lo is not None]
        return case_chain(branches, RANGE_BUCKETS[0][0])
    if mode != "gapfree":
        raise ValueError("mode must be 'gapfree' or 'faithful'")
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for label, _, _, hi in RANGE_BUCKETS[:-1]:
        expr = expr.when(v < hi + 1, label)
    return expr.otherwise(RANGE_BUCKETS[-1][0])


def range_bucket_order(label: str | Column) -> Column:
    """Order index (0..5) of a range label, for sorting categories."""
    lab = _c(label)
    return case_chain([(lab == name, F.lit(idx).cast("int"))
                       for name, idx, _, _ in RANGE_BUCKETS])


def concat_text(*parts: str | Column, sep: str | None = None) -> Column:
    """FN17: text concatenation (``paste0``), optionally with a separator.

    Non-text parts are cast to string; with ``sep`` NULL parts are skipped
    (``concat_ws``), without it a NULL part makes the result NULL (``concat``).
    """
    cols = [_c(p).cast("string") for p in parts]
    return F.concat_ws(sep, *cols) if sep is not None else F.concat(*cols)


def power(col: str | Column, exponent: float) -> Column:
    """FN1: ``x ^ e``."""
    return F.pow(_c(col), F.lit(exponent))
