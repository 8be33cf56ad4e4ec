"""The reports over stored tiers. Each reads no more partitions than its time range touches."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from millrace.functions.clock import floor_to, to_utc
from millrace.operators import reports
from millrace.schemas import DAY, HOUR, HOUR_TIER, MINUTE_TIER, RAW_TIER
from millrace.sources.tiers import TierTables


def latest_reading(
    tables: TierTables, now: datetime | str, freshness: timedelta = reports.STATUS_FRESHNESS, **options
) -> DataFrame:
    return reports.latest_reading(tables.read(RAW_TIER, to_utc(now) - freshness), now, freshness, **options)


def minute_trend(tables: TierTables, now: datetime | str, span: timedelta = HOUR, ordered: bool = True) -> DataFrame:
    return reports.minute_trend(tables.read(MINUTE_TIER, to_utc(now) - span), now, span, ordered)


def hourly_report(tables: TierTables, now: datetime | str, days: int = 7, ordered: bool = True) -> DataFrame:
    return reports.hourly_report(tables.read(HOUR_TIER, to_utc(now) - days * DAY), now, days, ordered)


def daily_summary(tables: TierTables, now: datetime | str, days: int = 30, ordered: bool = True) -> DataFrame:
    return reports.daily_summary(tables.read(HOUR_TIER, to_utc(now) - days * DAY), now, days, ordered)


def machine_comparison(tables: TierTables, now: datetime | str, ordered: bool = True) -> DataFrame:
    return reports.machine_comparison(tables.read(MINUTE_TIER, floor_to(HOUR, now)), now, ordered)


def power_factor_alert(
    tables: TierTables, now: datetime | str, threshold: float = 0.90, span: timedelta = HOUR, ordered: bool = True
) -> DataFrame:
    return reports.power_factor_alert(tables.read(MINUTE_TIER, to_utc(now) - span), now, threshold, span, ordered)
