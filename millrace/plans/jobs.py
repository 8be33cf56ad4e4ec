"""Batch jobs. Each is safe to repeat: rows go in by key and marks move last."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.clock import floor_to, to_utc
from millrace.operators.cleanse import REASONS, cleanse, ingest_metrics, rejected, valid_readings
from millrace.operators.rollup import rollup_hour, rollup_minute
from millrace.schemas import DAY, HOUR_TIER, MINUTE, MINUTE_TIER, RAW_TIER, TIERS, Tier
from millrace.session import shared_dir
from millrace.sources.tiers import TierTables, Window


@dataclass(frozen=True)
class RollupConfig:
    """One edge of the cascade and the settings of its scheduled job.

    ``offset`` and ``first_span`` serve the marked variant: how far behind the clock a window
    ends, and how far back the very first one starts.
    """

    job: str
    source: Tier
    target: Tier
    bucket: timedelta
    lookback: timedelta
    offset: timedelta
    first_span: timedelta
    options: dict[str, Any] = field(default_factory=dict)

    def rows(self, tables: TierTables, window: Window) -> DataFrame:
        return self.rollup(tables.read(self.source, *window), window)

    def rollup(self, source: DataFrame, window: Window | tuple[()] = ()) -> DataFrame:
        """Target rows from rows of the source tier."""
        rollup = rollup_minute if self.source is RAW_TIER else rollup_hour
        made = rollup(source, *window, width=self.bucket, **self.options)
        # Options may leave a column out; the table has it all the same.
        absent = [f for f in self.target.schema.fields if f.name not in made.columns]
        return made.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


# Lookbacks, offsets and first spans of the two jobs.
MINUTE_JOB = RollupConfig(
    "raw_to_minute", RAW_TIER, MINUTE_TIER, MINUTE,
    lookback=timedelta(minutes=2), offset=timedelta(seconds=5), first_span=timedelta(seconds=120),
)
HOUR_JOB = RollupConfig(
    "minute_to_hour", MINUTE_TIER, HOUR_TIER, timedelta(hours=1),
    lookback=timedelta(hours=2), offset=timedelta(seconds=30), first_span=timedelta(seconds=7200),
)


# Days kept per tier name; raw and hour rows stay.
RETENTION_DAYS = {MINUTE_TIER.name: 14}


def run_rollup(
    tables: TierTables, config: RollupConfig, now: datetime | str, into: TierTables | None = None, repair: bool = False
) -> Window:
    """Recompute the last complete buckets within the lookback; ``into`` may be other tables.

    Reading one closed bucket again is what lets late readings in: a bucket still counts rows
    which arrive up to ``lookback - bucket`` after it closed. With ``repair`` the run also makes
    older buckets again that the source's change log names; see :func:`repair_late`.
    """
    end = floor_to(config.bucket, now)
    window = (end - config.lookback, end)
    names, changed = tables.read_changes(config.source) if repair else ([], None)
    batch = uuid.uuid4().hex if repair else None
    (into or tables).upsert(config.target, config.rows(tables, window), batch=batch)
    if names:
        repair_late(tables, config, changed, window[0], into)
        tables.drop_changes(config.source, names)
    return window


def repair_late(
    tables: TierTables, config: RollupConfig, changed: DataFrame, before: datetime, into: TierTables | None = None
) -> None:
    """Make the ``changed`` buckets before an instant again, from all the source holds of them now.

    A semi-join keeps the source's rows of just these buckets and machines, out of the partitions
    they lie in, so the work grows with what came late, not with the tier. Buckets from the instant on
    are left to the window that the job computes anyway. The target notes its own changes, so that
    the next tier is repaired in turn.
    """
    behind = changed.filter(F.col("time") < F.lit(before)).distinct()
    rows = config.rollup(tables.read_buckets(config.source, behind))
    (into or tables).upsert(config.target, rows, batch=uuid.uuid4().hex)


def checkpointed_rollup(
    tables: TierTables, config: RollupConfig, now: datetime | str, repair: bool = False
) -> Window | None:
    """Process from the job's mark to ``now - offset``, both floored to the bucket.

    Unfloored edges would write a bucket from its first seconds and then overwrite it from the
    rest. An empty window moves the mark, an error does not. With ``repair`` the run also makes
    buckets behind the mark again that the source's change log names.
    """
    mark = tables.read_mark(config.job)
    start = floor_to(config.bucket, mark if mark else to_utc(now) - config.first_span)
    end = floor_to(config.bucket, to_utc(now) - config.offset)
    if end <= start:
        return None
    names, changed = tables.read_changes(config.source) if repair else ([], None)
    batch = uuid.uuid4().hex if repair else None
    tables.upsert(config.target, config.rows(tables, (start, end)), batch=batch)
    if names:
        repair_late(tables, config, changed, start)
    tables.write_mark(config.job, end)
    tables.drop_changes(config.source, names)
    return start, end


def backfill(
    tables: TierTables,
    start: datetime | str,
    end: datetime | str,
    step: timedelta | None = None,
    configs: tuple[RollupConfig, ...] = (MINUTE_JOB, HOUR_JOB),
) -> None:
    """Rebuild the tiers over ``[start, end)``, the hours from the minutes just written.

    One job per tier by default; ``step`` splits a long range into pieces which can be repeated
    singly. Edges are widened to whole buckets of the coarsest tier.
    """
    coarsest = max(c.bucket for c in configs)
    start, end = floor_to(coarsest, start), _ceil_to(coarsest, end)
    for window in _pieces(start, end, step):
        for config in configs:
            tables.merge(config.target, config.rows(tables, window), window)


def run_retention(
    tables: TierTables, now: datetime | str, days: Mapping[str, int] = RETENTION_DAYS
) -> dict[str, bool]:
    """Apply retention to the tiers named; one that fails does not stop the others."""
    return {t.name: tables.apply_retention(t, days[t.name], now) for t in TIERS if t.name in days}


def run_upkeep(tables: TierTables, now: datetime | str, database: str | None = None) -> None:
    """Once a day: gather the small files of yesterday, and show the catalog what was written since."""
    today = floor_to(DAY, now)
    for tier in TIERS:
        tables.compact(tier, today - DAY, today)
    if database:
        tables.refresh(database, (today - DAY, to_utc(now)))


@dataclass(frozen=True)
class IngestCounts:
    """What one batch held: messages, good readings, and messages by the reason that rejects them."""

    messages: int
    valid: int
    rejected: dict[str, int]


def ingest_batch(
    tables: TierTables,
    messages: DataFrame,
    quarantine: str,
    batch: str | None = None,
    max_future_skew: timedelta | None = None,
    repairable: bool = False,
    also: Callable[[DataFrame], None] | None = None,
) -> IngestCounts:
    """Clean messages into the raw tier, the rest into the quarantine folder, and count both.

    ``repairable`` notes the touched buckets, for jobs that repair late ones; jobs that do not would
    let the notes add up. ``also`` gets the good readings before they go in.

    ``batch`` names the call: one that runs again under its name replaces its own rejects. Without
    a name every call is a batch of its own, so rejects of earlier ones stay. The counts are
    observed while the checked messages are written to the shared folder, from which both outputs
    are read: messages are parsed once, and a lost executor costs no second parse.
    """
    batch = batch or uuid.uuid4().hex
    checked = cleanse(messages, max_future_skew)
    # Of good messages only the readings are kept.
    bad = F.col("reject_reason").isNotNull()
    texts = {c: F.when(bad, F.col(c)).alias(c) for c in ("topic", "payload")}
    seen, staged = Observation("ingest"), shared_dir(tables.spark, "ingest")
    try:
        checked.withColumns(texts).drop("timestamp").observe(seen, *ingest_metrics()).write.parquet(f"{staged}/checked")
        checked = tables.spark.read.parquet(f"{staged}/checked")
        write_quarantine(rejected(checked), quarantine, batch)
        good = valid_readings(checked)
        if also:
            also(good)
        tables.upsert(RAW_TIER, good, batch=batch if repairable else None)
    finally:
        tables._fs_delete(staged)
    counts = seen.get
    return IngestCounts(counts["messages"], counts["valid"], {r: counts[r] for r in REASONS if counts[r]})


def write_quarantine(bad: DataFrame, path: str, batch: str) -> None:
    """Rejected messages by date and batch; a batch that runs again replaces its own rows."""
    (
        bad.withColumn("batch", F.lit(batch))
        .hint("rebalance", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch")
        .parquet(path)
    )


def _pieces(start: datetime, end: datetime, step: timedelta | None) -> Iterator[Window]:
    step = step or (end - start)
    while start < end:
        yield start, min(start + step, end)
        start += step


def _ceil_to(width: timedelta, value: datetime | str) -> datetime:
    floor = floor_to(width, value)
    return floor if floor == to_utc(value) else floor + width
