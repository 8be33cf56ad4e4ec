"""Telemetry messages: ``(topic, payload, received_at)`` in batch or as a stream.

``source_partition`` and ``source_offset`` may follow; where they are given, they go on with the reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import topic_regex

MESSAGE_SCHEMA = "topic string, payload string, received_at timestamp"


def read_messages(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Messages landed as JSON lines below ``path``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(MESSAGE_SCHEMA).options(**options).json(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Message columns from a Kafka source whose record key carries the telemetry topic.

    Partition and offset settle which of two messages with one arrival time is the later one.
    """
    place = {"partition": F.col("partition").cast("int").alias("source_partition"), "offset": F.col("offset").cast("long").alias("source_offset")}
    return records.select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("received_at"),
        *(column for name, column in place.items() if name in records.columns),
    )


def filter_topic(messages: DataFrame, pattern: str) -> DataFrame:
    """Keep topics matching ``pattern``, where ``+`` is a single-level wildcard."""
    return messages.filter(F.col("topic").rlike(topic_regex(pattern)))


def explode_batch(messages: DataFrame) -> DataFrame:
    """One message per reading; a payload that is no array passes through unchanged."""
    is_array = F.col("payload").rlike(r"^\s*\[")
    readings = F.when(is_array, F.from_json("payload", "array<string>"))
    return messages.withColumn("payload", F.explode(F.coalesce(readings, F.array("payload"))))


def build_topic(machine_id: Column, template: str = "energy/{machine_id}/data") -> Column:
    """The topic a reading is published on."""
    head, tail = template.split("{machine_id}")
    return F.concat(F.lit(head), machine_id, F.lit(tail))


def to_messages(readings: DataFrame, received_at: Column) -> DataFrame:
    """Readings as outgoing messages, one topic per machine."""
    return readings.select(
        build_topic(F.col("machine_id")).alias("topic"),
        F.to_json(F.struct(*readings.columns)).alias("payload"),
        received_at.alias("received_at"),
    )
