"""Keyed last-write-wins: deduplication and merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def dedupe_last(rows: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One whole row per key, the last by ``order_by``; null comes first.

    An aggregate, so of a key with very many copies each task passes on one row. One column, a
    timestamp or integer, makes it a hash aggregate; all columns are picked by the same ordering, hence
    from the same row, and of rows that tie it is either. A list of columns is compared one by one,
    and of rows that tie the greatest values stay, in the order of the columns: the same in every run.
    """
    if not isinstance(order_by, str):
        order = list(order_by)
        values = [c for c in rows.columns if c not in (*keys, *order)]
        last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_last"))
        return last.select(*keys, "_last.*").select(*rows.columns)
    arrival = F.col(order_by)
    if isinstance(rows.schema[order_by].dataType, TimestampType):
        arrival = F.unix_micros(arrival)
    ordering = F.coalesce(arrival.cast("bigint"), F.lit(-(2**62)))
    picked = [F.max_by(c, ordering).alias(c) for c in rows.columns if c not in (*keys, order_by)]
    last = rows.groupBy(*keys).agg(*picked, F.max(order_by).alias(order_by))
    return last.select(*rows.columns)


def merge_last(old: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with ``updates`` written over it. Both sides hold each key once.

    One full outer join, so that neither side is computed twice.
    """
    values = [c for c in old.columns if c not in keys]
    new = updates.select(*keys, F.struct(*values).alias("_new"))
    # Null tags are keys like others, so sides meet null-safely.
    new = new.select(*(F.col(k).alias(f"_key_{k}") for k in keys), "_new")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    joined = old.withColumn("_old", F.lit(True)).join(new, same, "full_outer")
    merged = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values
    ]
    named = [F.when(F.col("_old"), F.col(k)).otherwise(F.col(f"_key_{k}")).alias(k) for k in keys]
    return joined.select(*named, *merged).select(*old.columns)
