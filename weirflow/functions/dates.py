"""The two meanings of a date difference, and date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed from ``start`` to ``end`` (boundary counting)."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("long")


def months_between_boundaries(start: Column, end: Column) -> Column:
    """Month starts crossed from ``start`` to ``end`` (boundary counting)."""
    months = lambda c: F.year(c) * 12 + F.month(c)
    return (months(end) - months(start)).cast("long")


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """Whole units elapsed from ``start`` to ``end``: SECOND, HOUR, DAY, YEAR."""
    return F.timestamp_diff(unit, start, end).cast("long")



def ts(value: str | dt.datetime | Column) -> Column:
    """A zone-free timestamp literal; columns pass through."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def year_text(c: Column) -> Column:
    return F.date_format(c, "yyyy")


def month_text(c: Column) -> Column:
    return F.date_format(c, "MM")


def one_year_before(as_of: Column) -> Column:
    return as_of - F.make_ym_interval(F.lit(1))
