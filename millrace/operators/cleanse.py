"""Messages to clean raw readings: parse, check, coerce, date, and part the good from the bad."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clock import utc_date
from millrace.functions.numeric import is_finite, parse_number, whole_number
from millrace.schemas import ARRIVAL, MEASURES, RAW_SCHEMA, TAGS

REQUIRED = (*TAGS, *MEASURES)

# Every field as text: numbers are coerced later, so that "12.5kW" is not lost here.
_PAYLOAD_SCHEMA = ", ".join(f"`{f}` string" for f in (*REQUIRED, "timestamp", "_corrupt"))
_FIELDS = ", ".join(f"`{f}`: string" for f in (*REQUIRED, "timestamp"))
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Largest distance from 1970 a JavaScript date can hold.
_MAX_DATE_MS = 8_640_000_000_000_000


def parse_payload(messages: DataFrame) -> DataFrame:
    """Add the payload fields as text, and ``reject_reason`` where there is no JSON object.

    An array, number or text is valid JSON without fields, so its first field is missing.
    """
    # As an array of one, so that the parser reads to the end: a second object or text after the first one shows.
    text = F.trim(F.coalesce("payload", F.lit("")), F.lit(" \t\r\n"))
    parsed = messages.withColumn("_text", text).withColumn(
        "_list", F.from_json(F.concat(F.lit("["), "_text", F.lit("]")), f"array<struct<{_FIELDS}>>", _STRICT)
    ).withColumn("_json", F.get("_list", F.lit(0)))
    other_json = F.expr("try_parse_json(_text)").isNotNull() & ~F.col("_text").startswith("{") & (F.col("_text") != "null")
    # "{...}],[{...}" would close the array and open another one.
    one_object = (F.size("_list") == 1) & F.col("_text").startswith("{") & F.endswith("_text", F.lit("}"))
    reopened = F.col("_text").rlike(r"\}\s*\]\s*,\s*\[\s*\{")
    reason = F.when(other_json, F.lit(f"missing:{REQUIRED[0]}")).when(
        ~F.coalesce(one_object & F.col("_json").isNotNull(), F.lit(False)) | reopened, F.lit("bad_json")
    )
    fields = [F.col(f"_json.{f}").alias(f) for f in (*REQUIRED, "timestamp")]
    return parsed.select(*messages.columns, *fields, reason.alias("reject_reason"))


def check_required(rows: DataFrame) -> DataFrame:
    """The first field that is absent or null is the reason; an empty tag passes."""
    return _reject(rows, [F.when(F.col(f).isNull(), F.lit(f"missing:{f}")) for f in REQUIRED])


def coerce_numeric(rows: DataFrame) -> DataFrame:
    """Read the measures as doubles; text that is no number, then an infinite value, rejects the row."""
    # In two steps, as an expression that names a column twice computes it twice.
    wholes = {f"_{m}": whole_number(F.col(m)) for m in MEASURES}
    numbers = {m: parse_number(F.col(m), F.col(f"_{m}")) for m in MEASURES}
    rows = rows.withColumns(wholes).withColumns(numbers).drop(*wholes)
    checks = [F.when(F.col(m).isNull(), F.lit(f"nan:{m}")) for m in MEASURES]
    checks += [F.when(~is_finite(F.col(m)), F.lit(f"non_finite:{m}")) for m in MEASURES]
    return _reject(rows, checks)


def event_time(text: Column, received_at: Column, ms: Column | None = None) -> Column:
    """ISO text or epoch milliseconds, their fraction cut off; anything else takes the arrival time.

    ``ms`` may be a column that holds :func:`epoch_ms` of the text already.
    """
    ms = epoch_ms(text) if ms is None else ms
    in_range = (ms != 0) & ms.between(-_MAX_DATE_MS, _MAX_DATE_MS)
    # A bare "12:30" would be taken as a time of the day the job runs on.
    is_date = text.rlike(r"^\s*\d{4}-")
    return F.coalesce(
        F.when(in_range, F.timestamp_millis(ms)),
        F.when(ms.isNull() & is_date, F.try_to_timestamp(text)),
        received_at,
    )


def epoch_ms(text: Column) -> Column:
    """The text as whole milliseconds: an integer, or a decimal within the range of dates.

    The JSON parser writes decimals with an exponent, so that form counts too.
    """
    decimal = F.when(text.rlike(r"^\s*[+-]?\d+(\.\d*)?([eE][+]?\d+)?\s*$"), text.try_cast("double"))
    cut = F.when(F.abs(decimal) <= F.lit(float(_MAX_DATE_MS)), decimal.cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), cut)


def normalize_time(rows: DataFrame, max_future_skew: timedelta | None = None) -> DataFrame:
    """Add ``time``. With ``max_future_skew`` a reading dated too far ahead is rejected."""
    rows = rows.withColumn("_ms", epoch_ms(F.col("timestamp")))
    rows = rows.withColumn("time", event_time(F.col("timestamp"), F.col("received_at"), F.col("_ms"))).drop("_ms")
    if max_future_skew is None:
        return rows
    ahead = F.col("time") > F.col("received_at") + F.lit(max_future_skew)
    return _reject(rows, [F.when(ahead, F.lit("future_time"))])


def cleanse(messages: DataFrame, max_future_skew: timedelta | None = None) -> DataFrame:
    """All checks in order, in one pass without a shuffle."""
    return normalize_time(coerce_numeric(check_required(parse_payload(messages))), max_future_skew)


def valid_readings(checked: DataFrame) -> DataFrame:
    """Good rows in raw layout, with what is known of their arrival, which orders copies of a key."""
    arrival = [c for c in ARRIVAL.names if c in checked.columns]
    return _where(checked, F.col("reject_reason").isNull(), *RAW_SCHEMA.names, *arrival)


def rejected(checked: DataFrame) -> DataFrame:
    """Bad messages as they came, with the reason."""
    columns = ("topic", "payload", "received_at", "reject_reason")
    bad = _where(checked, F.col("reject_reason").isNotNull(), *columns)
    return bad.withColumn("date", utc_date(F.col("received_at")))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_readings(checked), rejected(checked)


def reject_counts(checked: DataFrame) -> DataFrame:
    return rejected(checked).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


#: Every reason a message can be rejected for, in the order of the checks.
REASONS = (
    "bad_json", *(f"missing:{f}" for f in REQUIRED), *(f"nan:{m}" for m in MEASURES),
    *(f"non_finite:{m}" for m in MEASURES), "future_time",
)


def ingest_metrics() -> list[Column]:
    """Aggregates over checked messages: how many came, how many are good, and how many each reason rejects."""
    reason = F.col("reject_reason")
    counts = [F.count_if(reason == r).alias(r) for r in REASONS]
    return [F.count(F.lit(1)).alias("messages"), F.count_if(reason.isNull()).alias("valid"), *counts]


def rule_project(messages: DataFrame) -> DataFrame:
    """Flat columns of the unchecked route: device time as ``ts_ms``, broker time as ``mqtt_ts``."""
    parsed = messages.withColumn("_json", F.from_json("payload", _PAYLOAD_SCHEMA))
    measures = ("power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor")
    return parsed.select(
        *(F.col(f"_json.{t}").alias(t) for t in TAGS),
        *(F.col(f"_json.{m}").try_cast("double").alias(m) for m in measures),
        F.col("_json.timestamp").try_cast("bigint").alias("ts_ms"),
        F.unix_millis("received_at").alias("mqtt_ts"),
    )


def _where(rows: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """``columns`` of the rows that meet the condition, without repeating the parse.

    A filter on a computed column is pushed below it with the whole expression copied in, here the
    JSON parse some twenty times. A generator, which yields one row or none, stays in its place.
    """
    return rows.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def _reject(rows: DataFrame, checks: list[Column]) -> DataFrame:
    return rows.withColumn("reject_reason", F.coalesce("reject_reason", *checks))
