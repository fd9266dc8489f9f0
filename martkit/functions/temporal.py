"""Date and time rules shared by the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz(value) -> Column:
    """Column or ``YYYY-MM-DD[ HH:MM:SS]`` text as a timestamp without zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def on_day(df: DataFrame, ts: str, ds: str) -> DataFrame:
    """Rows of one business day; a half-open range reaches the file scan (FLT-4)."""
    next_day = (dt.date.fromisoformat(ds) + dt.timedelta(days=1)).isoformat()
    return in_days(df, ts, ds, next_day)


def in_days(df: DataFrame, ts: str, start: str, end: str | None = None) -> DataFrame:
    """Rows with ``start <= ts < end``, compared in the column's own type;
    without ``end`` all from ``start`` on."""
    kind = df.schema[ts].dataType
    rows = df.filter(F.col(ts) >= F.lit(start).cast(kind))
    return rows if end is None else rows.filter(F.col(ts) < F.lit(end).cast(kind))


def since(df: DataFrame, ts: str, days: int, now: str) -> DataFrame:
    """Rows of the last ``days`` days before ``now`` (FLT-6)."""
    kind = df.schema[ts].dataType
    low = dt.datetime.fromisoformat(now) - dt.timedelta(days=days)
    return df.filter(F.col(ts) >= F.lit(low.isoformat(sep=" ")).cast(kind))


def active_at(df: DataFrame, start: str, end: str, now: Column) -> DataFrame:
    """Rows whose open interval contains ``now`` (FLT-2)."""
    return df.filter((F.col(start) < now) & (F.col(end) > now))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed days between two timestamps, not calendar days."""
    return F.extract(F.lit("DAY"), later - earlier)


def week_start(ts) -> Column:
    return F.trunc(ts, "week")


def month_start(ts) -> Column:
    return F.trunc(ts, "month")


def iso_week(ts) -> Column:
    return F.weekofyear(ts)


def iso_weekday(ts) -> Column:
    return F.weekday(ts) + 1


def local_time(utc_ts: Column, zone: Column) -> Column:
    """Wall-clock time of a UTC instant in ``zone``; null for a null zone. The
    session's own time zone plays no part."""
    return F.convert_timezone(F.lit("UTC"), zone, utc_ts.cast("timestamp_ntz"))
