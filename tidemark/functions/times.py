"""Time as UTC milliseconds in longs; nothing depends on the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def epoch_ms(stamp: Column) -> Column:
    """Milliseconds of a timestamp without time zone, read as UTC."""
    day = F.unix_date(stamp.cast("date")).cast("long") * DAY
    clock = (F.hour(stamp) * 3600 + F.minute(stamp) * 60).cast("long") * 1000
    return day + clock + F.floor(F.extract(F.lit("SECOND"), stamp) * 1000).cast("long")


def utc_date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / DAY).cast("int"))


def date_ms(day: Column) -> Column:
    return F.unix_date(day).cast("long") * DAY


def floor_minute(ms: Column) -> Column:
    return ms - F.pmod(ms, F.lit(MINUTE))


def ceil_minute(ms: Column) -> Column:
    """First whole minute at or after."""
    return floor_minute(ms + (MINUTE - 1))


def after_minute(ms: Column) -> Column:
    """First whole minute strictly after."""
    return floor_minute(ms) + MINUTE


def is_closed(open_ms: Column, now_ms: int | Column) -> Column:
    """Whether the minute that opens then has closed by now."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return open_ms < floor_minute(now)


def decision_time_ns(open_ms: Column) -> Column:
    """When a minute's values may be used first: its close, in nanoseconds."""
    return (open_ms + MINUTE) * 1_000_000
