"""Tier schemas and layouts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

TAGS = ("machine_id", "location")
KEY = ("machine_id", "location", "time")

# Order matters: validation reports the first failing measure in this order.
MEASURES = ("power_kw", "voltage_v", "current_a", "energy_kwh", "power_factor")

MINUTE = timedelta(minutes=1)
HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def _schema(doubles: tuple[str, ...], counted: bool) -> StructType:
    fields = [StructField("time", TimestampType()), *(StructField(t, StringType()) for t in TAGS)]
    fields += [StructField(d, DoubleType()) for d in doubles]
    if counted:
        fields.append(StructField("sample_count", LongType()))
    return StructType(fields)


ROLLUP_MEASURES = (
    "avg_power_kw",
    "sum_energy_kwh",
    "avg_voltage_v",
    "avg_current_a",
    "avg_power_factor",
    "min_power_kw",
    "max_power_kw",
)

RAW_SCHEMA = _schema(("power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor"), False)
ROLLUP_SCHEMA = _schema(ROLLUP_MEASURES, True)


# When and where a reading came in, compared in this order. It is the version of its row.
ARRIVAL = StructType([
    StructField("received_at", TimestampType()),
    StructField("source_partition", IntegerType()),
    StructField("source_offset", LongType()),
])


@dataclass(frozen=True)
class Tier:
    """One table of the cascade.

    ``partitions`` are derived from ``time``. Raw and minute tiers are cut by hour as well as by
    date, because the minute job rewrites every partition it touches once a minute. ``version`` holds
    columns that are stored with a row to tell which copy of a key is the later one; scans leave
    them out unless asked for. ``feeds`` is the width of the buckets that are made from the tier.
    """

    name: str
    schema: StructType
    partitions: tuple[str, ...]
    bucket: timedelta | None = None
    expected_samples: int | None = None
    version: StructType = StructType()
    feeds: timedelta | None = None

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, *self.version.fields])


RAW_TIER = Tier("energy_raw", RAW_SCHEMA, ("date", "hour_of_day"), version=ARRIVAL, feeds=MINUTE)
MINUTE_TIER = Tier("energy_minute", ROLLUP_SCHEMA, ("date", "hour_of_day"), MINUTE, 6, feeds=HOUR)
HOUR_TIER = Tier("energy_hour", ROLLUP_SCHEMA, ("date",), HOUR, 360)
TIERS = (RAW_TIER, MINUTE_TIER, HOUR_TIER)
