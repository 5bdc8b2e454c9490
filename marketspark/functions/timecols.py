"""Column expressions over UTC ``timestamp_ntz`` values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WEEK = 7 * 86400
# 1970-01-05 is the first Monday of the epoch: weekly buckets start there.
_MONDAY_US = 4 * 86400 * 1_000_000


def micros(ts: Column) -> Column:
    """Epoch microseconds of a UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def bucket_us(us: Column, seconds: int) -> Column:
    """Start of the left-closed bucket holding ``us``; weeks start on Monday."""
    origin = _MONDAY_US if seconds % _WEEK == 0 else 0
    return us - F.pmod(us - F.lit(origin), F.lit(seconds * 1_000_000))


def month_of(ts: Column) -> Column:
    """First day of the UTC month, the partition key of every stored table."""
    return F.trunc(ts.cast("date"), "month")


def period_start(ts: Column, unit: str) -> Column:
    """First day of the calendar period (weeks start on Monday)."""
    day = ts.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def eastern(ts: Column) -> Column:
    """New York wall-clock time of a UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)
