"""Sensor readings and messages derived from the benchmark's ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clock import iso_string, micros, to_utc
from millrace.schemas import RAW_SCHEMA
from millrace.sources.messages import build_topic

EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
BASE = to_utc("2024-01-01")

# Machine locations by number, as the five-machine plant has them.
LOCATIONS = ("produksi_a", "produksi_a", "produksi_b", "gudang", "office")


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The table with UTC timestamps; zone-less ones could not carry a watermark."""
    reader = (spark.readStream if stream else spark.read).schema(EVENT_SCHEMA)
    # A stream needs a folder or a pattern, and the table may be a single file.
    return reader.parquet(f"{sf_dir}/events.parquet" + ("*" if stream else ""))


def readings(source: DataFrame, pace: str = "fast", fleet: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Events as raw readings.

    ``pace="fast"`` squeezes the 30 days into 12 hours, so that minutes hold several readings;
    ``"wide"`` keeps the times. ``fleet`` makes every user a machine in place of five machines.
    """
    return _with_k(source).select(*reading_columns(pace, fleet), *extra).select(*RAW_SCHEMA.names, *extra)


def _with_k(source: DataFrame) -> DataFrame:
    """The number in ``props``, in a column of its own, as two measures need it."""
    return source.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))


def reading_columns(pace: str = "fast", fleet: bool = False) -> list[Column]:
    """Columns of a reading, over events with ``_k``."""
    k = F.col("_k")
    number = F.col("user_id") % F.lit(len(LOCATIONS))
    machine = F.col("user_id") if fleet else number + 1
    location = F.element_at(F.array(*(F.lit(x) for x in LOCATIONS)), (number + 1).cast("int"))
    return [
        _time(pace).alias("time"),
        F.concat(F.lit("machine_"), F.lpad(machine.cast("string"), 6 if fleet else 2, "0")).alias("machine_id"),
        location.alias("location"),
        (F.col("value") / 10).alias("power_kw"),
        (F.col("value") / 3600).alias("energy_kwh"),
        (F.lit(210.0) + k / F.lit(5.0)).alias("voltage_v"),
        (F.col("value") * 100 / 220).alias("current_a"),
        (F.lit(0.80) + k / F.lit(500.0)).alias("power_factor"),
    ]


def messages(source: DataFrame, pace: str = "fast") -> DataFrame:
    """Events as telemetry messages, some spoiled in each way the checks know.

    Every event gives one message; its number only picks how the payload is written.
    """
    clean = _with_k(source).select("event_id", *reading_columns(pace))
    kind = F.col("event_id") % 13
    power = F.col("power_kw").cast("string")
    fields = {
        "machine_id": F.when(kind != 1, F.col("machine_id")),
        "location": F.when(kind == 2, F.lit("")).otherwise(F.col("location")),
        "timestamp": message_time(F.col("time"), kind),
        "power_kw": F.when(kind == 3, F.concat(power, F.lit("kW")))
        .when(kind == 4, F.lit("n/a"))
        .when(kind == 5, F.lit("Infinity"))
        .otherwise(power),
        "voltage_v": F.when(kind != 6, F.col("voltage_v")),
        "current_a": F.col("current_a"),
        "energy_kwh": F.col("energy_kwh"),
        "power_factor": F.when(kind == 7, F.lit("")).otherwise(F.col("power_factor").cast("string")),
    }
    text = F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))
    payload = (
        F.when(kind == 8, F.concat(F.lit("{"), text))
        .when(kind == 9, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    topic = F.when(
        kind == 10,
        F.concat(F.lit("factory/"), F.col("location"), F.lit("/"), F.col("machine_id"), F.lit("/energy")),
    ).otherwise(build_topic(F.col("machine_id")))
    return clean.select(
        "event_id", topic.alias("topic"), payload.alias("payload"), F.col("time").alias("received_at")
    )


def message_time(time: Column, kind: Column) -> Column:
    """The device time ten seconds before arrival, in the forms devices send."""
    sent = time - F.expr("interval 10 seconds")
    millis = F.unix_millis(sent).cast("string")
    return (
        F.when(kind == 0, iso_string(sent))
        .when(kind == 3, F.lit("not a time"))
        .when(kind == 10, F.lit("0"))
        .when(kind == 11, F.date_format(sent + F.expr("interval 7 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+07:00'"))
        .when(kind != 12, millis)
    )


def _time(pace: str) -> Column:
    if pace == "wide":
        return F.col("ts")
    base = F.lit(micros(BASE))
    past = F.unix_micros("ts") - base
    # All events lie after the base, where dividing and flooring agree.
    return F.timestamp_micros(base + ((past - past % 60) / 60).cast("bigint"))


def batched_messages(source: DataFrame, pace: str = "fast") -> DataFrame:
    """Every event as one message of two readings, ten seconds apart."""
    clean = _with_k(source).select(*reading_columns(pace))

    def reading(sent: Column) -> Column:
        measures = ("power_kw", "voltage_v", "current_a", "energy_kwh", "power_factor")
        millis = F.unix_millis(sent).alias("timestamp")
        return F.struct("machine_id", "location", millis, *(F.col(m) for m in measures))

    both = F.array(reading(F.col("time")), reading(F.col("time") + F.expr("interval 10 seconds")))
    return clean.select(
        F.lit("energy/batch/data").alias("topic"), F.to_json(both).alias("payload"), F.col("time").alias("received_at")
    )
