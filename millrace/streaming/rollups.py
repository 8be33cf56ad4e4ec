"""Streaming jobs.

Watermarks follow event time, so a silent fleet holds its last buckets open; the batch job in
``millrace.plans.jobs`` closes them by the clock. One far-future reading would move the watermark
past good data: give ``ingest_stream`` a ``max_future_skew`` to keep such readings out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from millrace.functions.clock import micros
from millrace.operators.rollup import behind, finish_rollup, hour_measures, minute_measures, tag_columns
from millrace.plans.jobs import ingest_batch
from millrace.schemas import HOUR, MINUTE, MINUTE_TIER, RAW_SCHEMA, TAGS, Tier
from millrace.sources.folders import Folders
from millrace.sources.tiers import TierTables


_LATE_SCHEMA = StructType([
    *RAW_SCHEMA.fields, StructField("received_at", TimestampType()), StructField("stream", StringType()), StructField("batch", LongType()),
])


def seconds(span: timedelta) -> str:
    return f"{int(span.total_seconds())} seconds"


def minute_stream(raw: DataFrame, lateness: timedelta = MINUTE, width: timedelta = MINUTE) -> DataFrame:
    """Tumbling minute roll-up; a bucket takes readings up to ``lateness`` after its end.

    The window column stays, for chaining.
    """
    grouped = (
        raw.withWatermark("time", seconds(lateness))
        .groupBy(F.window("time", seconds(width)), *tag_columns())
        .agg(*minute_measures(), F.count(F.lit(1)).alias("sample_count"))
    )
    return _finish(grouped)


def hour_stream(minutes: DataFrame, width: timedelta = HOUR, weighting: str | None = None) -> DataFrame:
    """Hour roll-up chained onto :func:`minute_stream` within one append-mode query."""
    grouped = minutes.groupBy(F.window(F.window_time("window"), seconds(width)), *TAGS).agg(
        *hour_measures(weighting), F.sum("sample_count").alias("sample_count")
    )
    return _finish(grouped)


def start_rollup(
    rollup: DataFrame,
    tables: TierTables,
    target: Tier,
    checkpoint: str,
    mode: str = "append",
    every: timedelta | None = None,
) -> StreamingQuery:
    """Upsert a roll-up stream into its tier.

    ``append`` writes a bucket once, when it closes. ``update``, for the minute tier only, writes
    it early and again as readings arrive. Without ``every`` the query processes what is there and
    stops: the catch-up pass after a restart.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        tables.upsert(target, batch)

    return _start(rollup.drop("window"), upsert, checkpoint, mode, every)


@dataclass(frozen=True)
class LateSink(Folders):
    """Where a stream's late readings go, batch by batch; they stay in the raw tier as well.

    A reading is late if its bucket was closed by what earlier batches held: the latest reading time among them,
    less ``lateness``. That edge is kept below the folder with the number of the batch it was taken from, so a
    batch that runs again finds the edge it had, and replaces its rows.
    """

    path: str
    lateness: timedelta = MINUTE
    width: timedelta = MINUTE

    def read(self) -> DataFrame:
        return self.spark.read.schema(_LATE_SCHEMA).parquet(f"{self.path}/rows")

    def take(self, batch: DataFrame, stream: str, number: int) -> None:
        """Sink the late readings of a stream's batch, and move the edge."""
        edges = f"{self.path}/edges/{stream}"
        known = {int(n.split("-")[0]): int(n.split("-")[1]) for n in self._fs_list(edges)}
        edge = max((e for n, e in known.items() if n < number), default=0)
        late = behind(batch, F.timestamp_micros(F.lit(edge)), self.width)
        late.select(*RAW_SCHEMA.names, "received_at").write.mode("overwrite").parquet(f"{self.path}/rows/stream={stream}/batch={number}")
        newest = batch.agg(F.max(F.unix_micros("time"))).first()[0]
        after = max(edge, (newest or 0) - micros(self.lateness))
        self._fs_mkdirs(f"{edges}/{number}-{after}")
        for n, e in known.items():
            if n < number - 1:
                self._fs_delete(f"{edges}/{n}-{e}")


def ingest_stream(
    messages: DataFrame,
    tables: TierTables,
    quarantine: str,
    checkpoint: str,
    every: timedelta | None = None,
    max_future_skew: timedelta | None = None,
    repairable: bool = False,
    late: LateSink | None = None,
) -> StreamingQuery:
    """Clean messages into the raw tier as they arrive. A repeated batch changes nothing.

    Batches are named by checkpoint and number, so streams with checkpoints of their own, which all
    count from zero, keep their rejects apart.
    """
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def ingest(batch: DataFrame, batch_id: int) -> None:
        also = late and (lambda good: late.take(good, stream, batch_id))
        ingest_batch(tables, batch, quarantine, f"{stream}-{batch_id}", max_future_skew, repairable, also)

    return _start(messages, ingest, checkpoint, "append", every)


def start_minute_updates(raw: DataFrame, tables: TierTables, checkpoint: str, **options) -> StreamingQuery:
    """Minute roll-up with early values."""
    return start_rollup(minute_stream(raw), tables, MINUTE_TIER, checkpoint, mode="update", **options)


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks keep out, over all progress of each query.

    ``spark.streams.addListener`` it before the query starts; ``count`` takes the query's ``id``.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}

    def count(self, query_id: str) -> int:
        return self.counts.get(str(query_id), 0)

    def onQueryStarted(self, event) -> None:
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        key = str(event.progress.id)
        dropped = sum(state.numRowsDroppedByWatermark for state in event.progress.stateOperators)
        self.counts[key] = self.counts.get(key, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late_rows(query: StreamingQuery) -> int:
    """Input rows the watermark kept out in the query's recent progress, which Spark limits; :class:`LateRows` counts all."""
    states = (state for progress in query.recentProgress for state in progress["stateOperators"])
    return sum(state["numRowsDroppedByWatermark"] for state in states)


def _finish(grouped: DataFrame) -> DataFrame:
    return finish_rollup(grouped.withColumn("time", F.col("window.start")))


def _start(stream: DataFrame, write, checkpoint: str, mode: str, every: timedelta | None) -> StreamingQuery:
    trigger = {"processingTime": seconds(every)} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
