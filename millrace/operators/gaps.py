"""Buckets without any reading: the grid that should be there, less what is there, merged into gaps."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.clock import date_bin, micros
from millrace.functions.text import default_tag
from millrace.schemas import DAY, MINUTE, TAGS


def gap_report(rows: DataFrame, width: timedelta = MINUTE) -> DataFrame:
    """``machine_id, location, gap_start, gap_end, missing``: stretches of buckets between a machine's first
    and last reading that hold none; ``gap_end`` is the start of the next bucket that does.

    ``rows`` may be readings or a tier. Each machine's days become grids of their own, so no task holds a
    machine's whole time. Stretches are found within days; only those that touch a day's edge, two
    a day at most, are joined across days. A machine that is silent before its first or after its last reading
    has no gap there; rows without time count for nothing.
    """
    if DAY % width:
        raise ValueError("a day holds a whole number of buckets")
    tags = [default_tag(F.col(t)).alias(t) for t in TAGS]
    present = rows.filter(F.col("time").isNotNull()).select(*tags, date_bin(width, F.col("time")).alias("bucket")).distinct()
    spans = present.groupBy(*TAGS).agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
    step, day = F.lit(width), date_bin(DAY, F.col("first"))
    days = spans.select(*TAGS, "first", "last", F.explode(F.sequence(day, F.col("last"), F.lit(DAY))).alias("day"))
    ends = F.least(F.col("day") + F.lit(DAY) - step, F.col("last"))
    grid = days.select(*TAGS, "day", F.explode(F.sequence(F.greatest("day", "first"), ends, step)).alias("bucket"))
    missing = grid.join(present, [*TAGS, "bucket"], "left_anti")
    return _merged(_islands(missing, width))


def _islands(missing: DataFrame, width: timedelta) -> DataFrame:
    """Stretches of missing buckets within a day: along one, bucket less its number is the same."""
    number = F.row_number().over(Window.partitionBy(*TAGS, "day").orderBy("bucket"))
    island = F.unix_micros("bucket") - number.cast("long") * F.lit(micros(width))
    return missing.withColumn("_island", island).groupBy(*TAGS, "day", "_island").agg(
        F.min("bucket").alias("gap_start"), (F.max("bucket") + F.lit(width)).alias("gap_end"), F.count(F.lit(1)).alias("missing")
    )


def _merged(islands: DataFrame) -> DataFrame:
    columns = [*TAGS, "gap_start", "gap_end", "missing"]
    at_edge = (F.col("gap_start") == F.col("day")) | (F.col("gap_end") == F.col("day") + F.lit(DAY))
    inner, edges = islands.filter(~at_edge).select(*columns), islands.filter(at_edge).select(*columns)
    along = Window.partitionBy(*TAGS).orderBy("gap_start")
    begins = F.coalesce(F.lag("gap_end").over(along) != F.col("gap_start"), F.lit(True))
    numbered = edges.withColumn("_begins", begins.cast("int")).withColumn("_gap", F.sum("_begins").over(along))
    joined = numbered.groupBy(*TAGS, "_gap").agg(
        F.min("gap_start").alias("gap_start"), F.max("gap_end").alias("gap_end"), F.sum("missing").alias("missing")
    )
    return inner.unionByName(joined.select(*columns))

