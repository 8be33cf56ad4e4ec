"""Dashboard sections as tables: one row per machine, never the whole fleet in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import hour_label, iso_string
from millrace.functions.numeric import half_up, zero_fill

REALTIME_MEASURES = ("power_kw", "voltage_v", "current_a", "power_factor")


def realtime_section(latest: DataFrame) -> DataFrame:
    """Latest measures per machine, empty ones as 0."""
    return latest.select(
        "machine_id",
        "location",
        *(zero_fill(F.col(m)).alias(m) for m in REALTIME_MEASURES),
        iso_string(F.col("last_seen")).alias("last_seen"),
    )


def hour_labels(hourly: DataFrame) -> DataFrame:
    """One row with the sorted ``HH:00`` labels, 24 at most."""
    return hourly.agg(F.sort_array(F.collect_set(hour_label(F.col("hour_bucket")))).alias("labels"))


def line_chart_section(hourly: DataFrame) -> DataFrame:
    """Per machine its values in label order, 0 where an hour is missing.

    ``hourly`` holds one row per hour of one day and machine, so a machine gathers 24 at most. The labels are
    read off the same rows per machine; both uses need the same columns of them, so the exchange
    that makes them is run once and reused.
    """
    label = hour_label(F.col("hour_bucket"))
    value = zero_fill(half_up(F.col("energy_kwh"), 3))
    per_machine = hourly.groupBy("machine_id").agg(
        F.min("hour_bucket").alias("first_hour"),
        F.map_from_entries(F.collect_list(F.struct(label, value))).alias("by_label"),
    )
    per_machine = per_machine.filter(F.col("first_hour").isNotNull())
    seen = per_machine.select(F.explode(F.map_keys("by_label")).alias("label"))
    labels = seen.agg(F.sort_array(F.collect_set("label"))).scalar()
    data = F.transform(F.col("labels"), lambda h: F.coalesce(F.col("by_label")[h], F.lit(0.0)))
    return (
        per_machine.withColumn("labels", labels)
        .select("machine_id", "first_hour", "labels", data.alias("data"))
    )


def dense_hourly_grid(hourly: DataFrame) -> DataFrame:
    """The line chart in long form: every label for every machine."""
    series = line_chart_section(hourly)
    return series.select("machine_id", F.explode(F.arrays_zip("labels", "data")).alias("p")).select(
        "machine_id", F.col("p.labels").alias("hour_label"), F.col("p.data").alias("energy_kwh")
    )


def pie_chart_section(share: DataFrame) -> DataFrame:
    """Total per machine; the order is by the unrounded total."""
    return share.select("machine_id", "total_kwh", half_up(F.col("total_kwh"), 3).alias("value"))


def json_text(value: Column) -> Column:
    """A JSON value. ``to_json`` takes no scalars, so it writes an array and the brackets go."""
    text = F.to_json(F.array(value))
    return text.substr(F.lit(2), F.length(text) - 2)
