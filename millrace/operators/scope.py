"""Time-range predicates. They test the ``time`` column itself, so scans can use them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import Instant, date_bin, instant
from millrace.schemas import DAY, HOUR


def time_range(rows: DataFrame, start: Instant | None, end: Instant | None) -> DataFrame:
    """Half open: ``start <= time < end``; a missing bound is open."""
    if start is not None:
        rows = rows.filter(F.col("time") >= instant(start))
    if end is not None:
        rows = rows.filter(F.col("time") < instant(end))
    return rows


def since(rows: DataFrame, now: Instant, span: timedelta) -> DataFrame:
    """``time >= now - span``. There is no upper bound: rows from the future pass."""
    return rows.filter(F.col("time") >= instant(now) - F.lit(span))


def today(rows: DataFrame, now: Instant) -> DataFrame:
    """The whole UTC day of ``now``."""
    day = _floor(DAY, now)
    return time_range(rows, day, day + F.lit(DAY))


def today_so_far(rows: DataFrame, now: Instant) -> DataFrame:
    return time_range(rows, _floor(DAY, now), now)


def current_hour(rows: DataFrame, now: Instant) -> DataFrame:
    """From the start of the running hour, without an upper bound."""
    return time_range(rows, _floor(HOUR, now), None)


def retain(rows: DataFrame, cutoff: Instant) -> DataFrame:
    """Rows retention keeps; a row exactly at the cutoff stays."""
    return time_range(rows, cutoff, None)


def _floor(width: timedelta, now: Instant) -> Column:
    return date_bin(width, instant(now))
