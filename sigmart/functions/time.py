"""Time helpers for TIMESTAMP_NTZ columns that do not depend on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def ntz(value: str | datetime | Column) -> Column:
    """A TIMESTAMP_NTZ column from an ISO string, a naive datetime or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return day_of(ts) + F.make_dt_interval(hours=F.hour(ts))


def hours_after(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def minutes_after(ts: Column, minutes: Column | int) -> Column:
    mins = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return ts + F.make_dt_interval(mins=mins)


def hour_index(ts: Column) -> Column:
    """Whole hours since 1970-01-01."""
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)
