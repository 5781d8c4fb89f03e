"""Time helpers. Instants are UTC; nothing here reads the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(seconds: float) -> Column:
    """A fixed interval of ``seconds``."""
    return F.lit(dt.timedelta(seconds=seconds))


def instant(value: Column | dt.datetime | str) -> Column:
    """An ``as_of`` argument as a timestamp column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact fractional seconds between two instants."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(ts) + F.lit(1)


def utc_to_local(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` for a UTC instant (UTC session)."""
    return F.from_utc_timestamp(ts, zone)


def local_to_utc(ts: Column, zone: str) -> Column:
    """UTC instant of a wall-clock time in ``zone``; the zone decides about DST.

    A time that occurs twice when clocks go back an hour means the later one
    (standard time); a time skipped in spring moves on by the gap.
    """
    first = F.to_utc_timestamp(ts, zone)
    second = first + span(3600)
    return F.when(F.from_utc_timestamp(second, zone) == ts, second).otherwise(first)


def time_bucket(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide bucket inside the hour."""
    step = F.floor(F.minute(ts) / F.lit(minutes)) * F.lit(minutes * 60)
    return F.timestamp_seconds(F.unix_seconds(F.date_trunc("hour", ts)) + step)
