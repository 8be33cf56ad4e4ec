"""Time expressions. None of them depends on the session time zone except :func:`iso_string`."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
Instant = Column | datetime | str

_DAY_US = 86_400_000_000
_HOUR_US = 3_600_000_000


def to_utc(value: datetime | str) -> datetime:
    """Python side instant; a value without an offset is UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def micros(value: datetime | timedelta) -> int:
    span = value - EPOCH if isinstance(value, datetime) else value
    return span // timedelta(microseconds=1)


def instant(value: Instant) -> Column:
    """A timestamp column. Literals fold to a constant, so they still reach the scan."""
    if isinstance(value, Column):
        return value
    return F.timestamp_micros(F.lit(micros(to_utc(value))))


def floor_to(width: timedelta, value: datetime | str) -> datetime:
    value = to_utc(value)
    return value - (value - EPOCH) % width


def date_bin(width: timedelta, time: Column, origin: datetime | str = EPOCH) -> Column:
    """Start of the ``width`` bucket holding ``time``, buckets counted from ``origin``."""
    us = F.unix_micros(time)
    offset = us - F.lit(micros(to_utc(origin)))
    return F.timestamp_micros(us - F.pmod(offset, F.lit(micros(width))))


def floor_div(value: Column, unit: int) -> Column:
    """Whole number of units, rounded down, in integers: doubles lose the last digits of large values."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit))


def utc_date(time: Column) -> Column:
    return F.date_from_unix_date(floor_div(F.unix_micros(time), _DAY_US).cast("int"))


def utc_hour(time: Column) -> Column:
    into_day = F.pmod(F.unix_micros(time), F.lit(_DAY_US))
    return F.floor(into_day / F.lit(_HOUR_US)).cast("int")


def hour_label(time: Column) -> Column:
    """``HH:00`` in UTC."""
    return F.concat(F.lpad(utc_hour(time).cast("string"), 2, "0"), F.lit(":00"))


def iso_string(time: Column) -> Column:
    """``2026-06-30T08:00:00.000Z``, in any session."""
    ms = F.floor(F.pmod(F.unix_micros(time), F.lit(_DAY_US)) / F.lit(1000))
    parts = [F.floor(ms / F.lit(unit)) % F.lit(size) for unit, size in ((3_600_000, 24), (60_000, 60), (1000, 60), (1, 1000))]
    return F.concat(utc_date(time).cast("string"), F.format_string("T%02d:%02d:%02d.%03dZ", *parts))


def unix_nanos(time: Column) -> Column:
    """Null beyond the years that 64-bit nanoseconds reach, 1677 to 2262."""
    return F.try_multiply(F.unix_micros(time), F.lit(1000))


def from_unix_nanos(nanos: Column) -> Column:
    """The microsecond that holds the nanosecond."""
    # The first nanoseconds of 64 bits have no whole microsecond below them that fits.
    whole = 2**63 // 1000
    us = F.when(nanos < F.lit(-whole * 1000), F.lit(-whole - 1)).otherwise(floor_div(nanos, 1000))
    return F.timestamp_micros(us)


def from_unix_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
