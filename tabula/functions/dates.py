"""Date arithmetic (FN7-FN16, AGG17).

Text is converted with the ``try_*`` functions: in ANSI mode a plain
``to_date``/``unix_timestamp`` raises on a bad string, whereas the recipes
expect NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col: str | Column, fmt: str = "MM/dd/yyyy") -> Column:
    """FN7: text in a custom pattern → date (NULL when it does not parse)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("date")


def parse_unix_seconds(col: str | Column, fmt: str = "MM/dd/yyyy", tz: str = "UTC") -> Column:
    """FN7 first step: text → seconds since the epoch (NULL when it does not parse).

    The text is a wall-clock time in zone ``tz`` (UTC by default), so the
    result does not depend on the session time zone.
    """
    wall = F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")
    at = F.make_timestamp(F.year(wall), F.month(wall), F.dayofmonth(wall), F.hour(wall),
                          F.minute(wall), F.second(wall).cast("decimal(16,6)"), F.lit(tz))
    return F.unix_seconds(at)


def parse_iso_date(col: str | Column) -> Column:
    """FN8: ISO ``yyyy-MM-dd`` text (or a timestamp) → date."""
    return F.try_to_date(_c(col).cast("string"))


def month_end(col: str | Column) -> Column:
    """FN9: last day of the month."""
    return F.last_day(_c(col))


def next_weekday(col: str | Column, day: str = "Sunday") -> Column:
    """FN10: first given weekday strictly after the date."""
    return F.next_day(_c(col), day)


def shift_months(col: str | Column, months: int) -> Column:
    """FN11: add months, clamping to the month end (Jan 31 + 1 → Feb 28/29)."""
    return F.add_months(_c(col), months)


def shift_days(col: str | Column, days: int) -> Column:
    """FN12: add (or, when negative, subtract) days."""
    return F.date_add(_c(col), days) if days >= 0 else F.date_sub(_c(col), -days)


def date_parts(col: str | Column) -> dict[str, Column]:
    """FN13/FN16: ISO week of year, day of year, day of month, year, month."""
    d = _c(col)
    return {
        "week_of_year": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
        "day_of_month": F.dayofmonth(d),
        "year": F.year(d),
        "month": F.month(d),
    }


def months_between(end: str | Column, start: str | Column) -> Column:
    """FN14: months between two dates (31-day month fraction, 8 digits)."""
    return F.months_between(_c(end), _c(start))


def days_between(end: str | Column, start: str | Column) -> Column:
    """FN15: whole days from ``start`` to ``end``."""
    return F.datediff(_c(end), _c(start))


_UNITS = {"day", "week", "month", "quarter", "year"}


def period_start(col: str | Column, unit: str) -> Column:
    """AGG17: the date a value is re-sampled to (start of its day/week/month/...)."""
    unit = unit.lower()
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {sorted(_UNITS)}")
    return F.date_trunc(unit, _c(col)).cast("date")
