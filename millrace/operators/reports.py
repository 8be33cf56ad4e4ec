"""Operating queries on the tiers. ``now`` is always given, never read from the clock.

Results come in display order; ``ordered=False`` spares the sort where they are processed further.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.clock import Instant, date_bin
from millrace.functions.numeric import half_up, zero_fill
from millrace.operators.scope import current_hour, since, today, today_so_far
from millrace.schemas import DAY, HOUR, TAGS

STATUS_FRESHNESS = timedelta(minutes=5)
DASHBOARD_FRESHNESS = timedelta(seconds=60)


def latest_reading(
    raw: DataFrame,
    now: Instant,
    freshness: timedelta = STATUS_FRESHNESS,
    measures: Sequence[str] = ("power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor"),
    by: Sequence[str] = TAGS,
    prefix: str = "latest_",
    ordered: bool = True,
) -> DataFrame:
    """Last value of each measure per group, all from one row: of rows at one time, that of the greatest other tag."""
    others = [t for t in TAGS if t not in by]
    order = F.struct("time", *others) if others else F.col("time")
    last = [F.max_by(m, order).alias(f"{prefix}{m}") for m in measures]
    grouped = since(raw, now, freshness).groupBy(*by).agg(*last, F.max("time").alias("last_seen"))
    return grouped.orderBy(*by) if ordered else grouped


def minute_trend(minute: DataFrame, now: Instant, span: timedelta = HOUR, ordered: bool = True) -> DataFrame:
    trend = since(minute, now, span).select(
        F.col("time").alias("bucket"),
        *TAGS,
        "avg_power_kw",
        "sum_energy_kwh",
        "avg_voltage_v",
        "avg_power_factor",
        "min_power_kw",
        "max_power_kw",
    )
    return trend.orderBy("machine_id", "bucket") if ordered else trend


def hourly_report(hour: DataFrame, now: Instant, days: int = 7, ordered: bool = True) -> DataFrame:
    report = since(hour, now, timedelta(days=days)).select(
        F.col("time").alias("hour_bucket"),
        *TAGS,
        "sum_energy_kwh",
        "avg_power_kw",
        "max_power_kw",
        "avg_power_factor",
        "sample_count",
    )
    return report.orderBy("machine_id", "hour_bucket") if ordered else report


def daily_summary(hour: DataFrame, now: Instant, days: int = 30, ordered: bool = True) -> DataFrame:
    summary = (
        since(hour, now, timedelta(days=days))
        .groupBy(date_bin(DAY, F.col("time")).alias("day"), *TAGS)
        .agg(
            F.sum("sum_energy_kwh").alias("total_energy_kwh"),
            F.avg("avg_power_kw").alias("avg_power_kw"),
            F.max("max_power_kw").alias("peak_power_kw"),
            F.avg("avg_power_factor").alias("avg_power_factor"),
            F.sum("sample_count").alias("total_samples"),
        )
    )
    return summary.orderBy("machine_id", "day") if ordered else summary


def machine_comparison(minute: DataFrame, now: Instant, ordered: bool = True) -> DataFrame:
    """The running hour, highest consumption first."""
    compared = (
        current_hour(minute, now)
        .groupBy(*TAGS)
        .agg(
            F.sum("sum_energy_kwh").alias("energy_kwh_this_hour"),
            F.avg("avg_power_kw").alias("avg_power_kw"),
            F.max("max_power_kw").alias("peak_power_kw"),
            F.min("min_power_kw").alias("min_power_kw"),
            F.avg("avg_power_factor").alias("avg_pf"),
        )
    )
    return compared.orderBy(F.col("energy_kwh_this_hour").desc(), *TAGS) if ordered else compared


def power_factor_alert(
    minute: DataFrame, now: Instant, threshold: float = 0.90, span: timedelta = HOUR, ordered: bool = True
) -> DataFrame:
    """Machines whose mean power factor is strictly below the threshold, worst first."""
    alerts = (
        since(minute, now, span)
        .groupBy(*TAGS)
        .agg(F.avg("avg_power_factor").alias("avg_pf_last_hour"), F.count(F.lit(1)).alias("sample_count"))
        .filter(F.col("avg_pf_last_hour") < threshold)
    )
    return alerts.orderBy("avg_pf_last_hour", *TAGS) if ordered else alerts


def hourly_energy(hour: DataFrame, now: Instant, ordered: bool = True) -> DataFrame:
    """Energy per hour of today and machine, locations merged."""
    grouped = (
        today(hour, now)
        .groupBy(date_bin(HOUR, F.col("time")).alias("hour_bucket"), "machine_id")
        .agg(F.sum("sum_energy_kwh").alias("energy_kwh"))
    )
    return grouped.orderBy("hour_bucket", "machine_id") if ordered else grouped


def energy_share(minute: DataFrame, now: Instant, ordered: bool = True) -> DataFrame:
    """Energy per machine of today so far, largest first."""
    grouped = today_so_far(minute, now).groupBy("machine_id").agg(F.sum("sum_energy_kwh").alias("total_kwh"))
    return grouped.orderBy(F.col("total_kwh").desc(), "machine_id") if ordered else grouped


def total_power(latest: DataFrame, column: str = "power_kw") -> DataFrame:
    """One row: power of all machines, 0 where there is none."""
    total = F.coalesce(F.sum(zero_fill(F.col(column))), F.lit(0.0))
    return latest.agg(half_up(total, 2).alias("total_power_kw"))


def peak_hour_flag(hour: DataFrame, days: int = 30, ratio: float = 0.8, base: str = "max_power_kw") -> DataFrame:
    """1 where the hour's peak exceeds ``ratio`` of the machine's rolling mean, this hour included.

    The hour tier has one row per machine and hour, which bounds a window group by the hours of
    history: 8,784 rows a year.
    """
    seconds = F.col("time").cast("bigint")
    window = W.partitionBy(*TAGS).orderBy(seconds).rangeBetween(-days * 86_400, 0)
    mean = F.avg(base).over(window)
    return hour.select(
        "time",
        *TAGS,
        "max_power_kw",
        mean.alias("rolling_avg"),
        (F.col("max_power_kw") > F.lit(ratio) * mean).cast("int").alias("peak_hour_flag"),
    )
