"""Raw to minute to hour, plus the checks that hang on sample counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import Instant, date_bin, instant
from millrace.functions.numeric import zero_fill
from millrace.functions.text import default_tag
from millrace.operators.scope import time_range
from millrace.schemas import HOUR, MINUTE, ROLLUP_MEASURES, TAGS


def minute_measures() -> list[Column]:
    return [
        F.avg("power_kw").alias("avg_power_kw"),
        F.sum("energy_kwh").alias("sum_energy_kwh"),
        F.avg("voltage_v").alias("avg_voltage_v"),
        F.avg("current_a").alias("avg_current_a"),
        F.avg("power_factor").alias("avg_power_factor"),
        F.min("power_kw").alias("min_power_kw"),
        F.max("power_kw").alias("max_power_kw"),
    ]


def hour_measures(weighting: str | None = None) -> list[Column]:
    """Averages are means of minute means. ``weighting="sample_count"`` gives true means."""
    averaged = ("avg_power_kw", "avg_voltage_v", "avg_current_a", "avg_power_factor")
    means = {c: F.avg(c) if weighting is None else _weighted_mean(c, weighting) for c in averaged}
    return [
        means["avg_power_kw"].alias("avg_power_kw"),
        F.sum("sum_energy_kwh").alias("sum_energy_kwh"),
        *(means[c].alias(c) for c in averaged[1:]),
        F.min("min_power_kw").alias("min_power_kw"),
        F.max("max_power_kw").alias("max_power_kw"),
    ]


def rollup_minute(
    raw: DataFrame,
    start: Instant | None = None,
    end: Instant | None = None,
    width: timedelta = MINUTE,
    with_count: bool = True,
) -> DataFrame:
    """Raw readings in ``[start, end)`` per bucket and machine."""
    count = F.count(F.lit(1)) if with_count else None
    return _rollup(time_range(raw, start, end), width, minute_measures(), count)


def rollup_hour(
    minute: DataFrame,
    start: Instant | None = None,
    end: Instant | None = None,
    width: timedelta = HOUR,
    weighting: str | None = None,
    count_mode: str = "samples",
) -> DataFrame:
    """Minute rows in ``[start, end)`` per bucket and machine.

    ``count_mode="samples"`` adds up raw readings, ``"rows"`` counts minute rows.
    """
    counts = {"samples": lambda: F.sum("sample_count"), "rows": lambda: F.count(F.lit(1))}
    return _rollup(time_range(minute, start, end), width, hour_measures(weighting), counts[count_mode]())


def finish_rollup(grouped: DataFrame) -> DataFrame:
    """Fill empty measures, after the aggregate."""
    return grouped.withColumns({c: zero_fill(F.col(c)) for c in ROLLUP_MEASURES})


def tag_columns() -> list[Column]:
    return [default_tag(F.col(t)).alias(t) for t in TAGS]


def completeness(tier: DataFrame, expected: int, threshold: float | None = None) -> DataFrame:
    """Share of the expected samples per bucket; with a threshold, the buckets below it."""
    share = (F.col("sample_count") / F.lit(expected)).alias("completeness")
    scored = tier.select("time", *TAGS, "sample_count", share)
    return scored if threshold is None else scored.filter(F.col("completeness") < threshold)


def late_rows(raw: DataFrame, received_at: str, width: timedelta, lateness: timedelta) -> DataFrame:
    """Readings which arrived after their bucket was last recomputed; they stay in raw only."""
    closes = date_bin(width, F.col("time")) + F.lit(width + lateness)
    return raw.filter(F.col(received_at) >= closes)


def behind(raw: DataFrame, edge: Instant, width: timedelta = MINUTE) -> DataFrame:
    """Readings whose bucket was closed at ``edge``."""
    return raw.filter(date_bin(width, F.col("time")) + F.lit(width) <= instant(edge))


def _rollup(rows: DataFrame, width: timedelta, measures: list[Column], count: Column | None) -> DataFrame:
    if count is not None:
        measures = [*measures, count.alias("sample_count")]
    keys = [date_bin(width, F.col("time")).alias("time"), *tag_columns()]
    dated = rows.filter(F.col("time").isNotNull())
    return finish_rollup(dated.groupBy(*keys).agg(*measures))


def _weighted_mean(column: str, weight: str) -> Column:
    total = F.sum(F.col(column) * F.col(weight))
    return total / F.nullif(F.sum(weight), F.lit(0))
