"""Cumulative meter readings to energy per reading."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.clock import date_bin
from millrace.schemas import HOUR, TAGS


def meter_to_delta(
    raw: DataFrame, column: str = "energy_kwh", segments: Sequence[timedelta] = (HOUR,)
) -> DataFrame:
    """Replace the meter reading by its growth since the machine's previous reading.

    A falling reading means the meter was reset: the new reading counts in full. The first
    reading of a machine has no growth and becomes null.

    Each segment level costs one more pass over key, time and value. Hours hold few enough readings
    for a task, and a machine has few enough hours; readings at a far higher rate may want a finer level.
    """
    seen = with_previous(raw, TAGS, "time", column, segments)
    growth = F.col(column) - F.col("previous")
    delta = F.when(growth < 0, F.col(column)).otherwise(growth)
    return seen.withColumn(column, delta).select(*raw.columns)


def with_previous(
    rows: DataFrame, keys: Sequence[str], time: str, value: str, segments: Sequence[timedelta]
) -> DataFrame:
    """Add ``previous``: the value of the key's row before this one.

    A plain ``lag`` per key would put a whole machine into one task. Instead each key is cut into
    time segments, and each segment is led by one row with the last value of the key's segment
    before, found the same way among the segment ends, with the next wider segment. Times are
    unique per key, so no group outgrows what its segment can hold.
    """
    if not segments:
        return rows.withColumn("previous", F.lag(value).over(W.partitionBy(*keys).orderBy(time)))
    segment = f"_segment{len(segments)}"
    bin_ = date_bin(segments[0], F.col(time)).alias(segment)
    ends = rows.groupBy(*keys, bin_).agg(F.max_by(value, time).alias("_end"))
    leads = with_previous(ends, keys, segment, "_end", segments[1:]).select(
        *keys, segment, F.col("previous").alias(value), F.lit(True).alias("_lead")
    )
    led = rows.select("*", bin_, F.lit(False).alias("_lead")).unionByName(leads, allowMissingColumns=True)
    window = W.partitionBy(*keys, segment).orderBy(F.col("_lead").desc(), time)
    return (
        led.withColumn("previous", F.lag(value).over(window))
        .filter(~F.col("_lead"))
        .select(*rows.columns, "previous")
    )
