"""Bulk import and export of the text form ``table,tag=v,... field=v,... timestamp``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from millrace.functions.clock import Instant, from_unix_nanos, instant, unix_nanos
from millrace.functions.numeric import is_finite
from millrace.functions.text import escape_tag, unescape_tag
from millrace.schemas import TAGS, Tier

_TIMESTAMPS = {
    "ns": from_unix_nanos,
    "us": F.timestamp_micros,
    "ms": F.timestamp_millis,
    "s": F.timestamp_seconds,
}
# Last stamp of each precision whose time fits 64-bit microseconds; the first one is its negative.
_LAST = {"ns": 2**63 - 1, "us": 2**63 - 1, "ms": (2**63 - 1) // 1000, "s": (2**63 - 1) // 1_000_000}


def to_lines(rows: DataFrame, tier: Tier) -> DataFrame:
    """One text column ``value``. Integers carry the ``i`` suffix, times are nanoseconds.

    The form has neither empty tags nor numbers that are not finite; these are left out, and so
    are rows without any value and rows whose time has no nanoseconds of 64 bits.
    """
    tags = [F.when(F.col(t) != "", F.concat(F.lit(f"{t}="), escape_tag(F.col(t)))) for t in TAGS]
    head = F.concat_ws(",", F.lit(tier.name), *tags)
    fields = F.concat_ws(",", *(_field(f.name, f.dataType) for f in _fields(tier.schema)))
    nanos = unix_nanos(F.col("time"))
    line = F.concat_ws(" ", head, fields, nanos.cast("string"))
    return rows.filter((fields != "") & (nanos.isNotNull() | F.col("time").isNull())).select(line.alias("value"))


def write_line_protocol(rows: DataFrame, path: str, tier: Tier) -> None:
    to_lines(rows, tier).write.mode("overwrite").text(path)


def checked_lines(lines: DataFrame, tier: Tier, precision: str = "ns", default_time: Instant | None = None) -> DataFrame:
    """Typed rows of ``tier`` from a text column ``value``, with the line and why it is refused, if it is.

    Lines of other tables, blank lines and comments are left out. A line without a time gets
    ``default_time``. Of repeated tags and fields the last counts.
    """
    parts = F.split(F.trim("value"), r"(?<!\\) +")
    head = F.split(parts[0], r"(?<!\\),")
    parsed = lines.filter(head[0] == tier.name).select(
        "value",
        F.slice(head, 2, F.size(head)).alias("tags"),
        F.split(F.get(parts, F.lit(1)), ",").alias("fields"),
        F.get(parts, F.lit(2)).alias("stamp"),
        F.size(parts).alias("n_parts"),
    )
    stamp = F.col("stamp").try_cast("bigint")
    time = F.when(stamp.between(-_LAST[precision], _LAST[precision]), _TIMESTAMPS[precision](stamp))
    if default_time is not None:
        time = F.when(F.col("stamp").isNull(), instant(default_time)).otherwise(time)
    columns = [time.alias("time"), *(unescape_tag(_entry("tags", t)).alias(t) for t in TAGS)]
    kinds = {f.name: f.dataType for f in _fields(tier.schema)}
    texts = {name: F.regexp_replace(_entry("fields", name), "i$", "") for name in kinds}
    columns += [texts[name].try_cast(kind).alias(name) for name, kind in kinds.items()]
    broken = F.lit(False)
    for name, kind in kinds.items():
        number = texts[name].try_cast(kind)
        usable = is_finite(number) if isinstance(kind, DoubleType) else number.isNotNull()
        broken = broken | (texts[name].isNotNull() & ~F.coalesce(usable, F.lit(False)))
    filled = F.coalesce(*texts.values()).isNotNull()
    reason = (
        F.when(F.col("n_parts") > 3, "too many parts")
        .when(broken, "bad number")
        .when(~filled, "no fields")
        .when(time.isNull(), F.when(F.col("stamp").isNull(), "no time").otherwise("bad time"))
    )
    return parsed.select(*columns, "value", reason.alias("reject_reason"))


def from_lines(lines: DataFrame, tier: Tier, precision: str = "ns", default_time: Instant | None = None) -> DataFrame:
    """Typed rows of ``tier``; ``rejected_lines`` has the lines that give none."""
    checked = checked_lines(lines, tier, precision, default_time)
    return checked.filter(F.col("reject_reason").isNull()).select(*tier.schema.names)


def rejected_lines(lines: DataFrame, tier: Tier, precision: str = "ns", default_time: Instant | None = None) -> DataFrame:
    """``value, reject_reason`` of the lines ``from_lines`` refuses."""
    checked = checked_lines(lines, tier, precision, default_time)
    return checked.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def read_line_protocol(
    spark: SparkSession, path: str, tier: Tier, precision: str = "ns", default_time: Instant | None = None
) -> DataFrame:
    return from_lines(spark.read.text(path), tier, precision, default_time)


def _fields(schema: StructType) -> list:
    return [f for f in schema.fields if f.name != "time" and f.name not in TAGS]


def _field(name: str, kind) -> Column:
    suffix = "i" if isinstance(kind, LongType) else ""
    # concat of a null is null and concat_ws leaves nulls out: an absent field is not written.
    text = F.concat(F.lit(f"{name}="), F.col(name).cast("string"), F.lit(suffix))
    return F.when(is_finite(F.col(name)), text) if isinstance(kind, DoubleType) else text


def _entry(entries: str, name: str) -> Column:
    """Value of the last ``name=value`` among the entries, or null."""
    prefix = f"{name}="
    own = F.filter(entries, lambda entry: entry.startswith(prefix))
    return F.try_element_at(own, F.lit(-1)).substr(len(prefix) + 1, 2**31 - 1)
