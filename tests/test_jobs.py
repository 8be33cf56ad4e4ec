from __future__ import annotations

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.rollup import rollup_hour, rollup_minute
from millrace.plans import stored
from millrace.plans.jobs import HOUR_JOB, MINUTE_JOB, backfill, checkpointed_rollup, ingest_batch, run_retention, run_rollup, run_upkeep
from millrace.schemas import HOUR_TIER, MINUTE_TIER, RAW_TIER
from millrace.sources.tiers import TierTables
from tests.conftest import at, rows_of

POWER = ("time", "machine_id", "avg_power_kw", "sample_count")


def test_scheduled_run_covers_the_last_closed_buckets(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(*((f"10:0{m}:10", "m1", "hall", float(m)) for m in range(5))))
    for _ in range(2):
        assert run_rollup(tables, MINUTE_JOB, "2024-01-01 10:03:20") == (at("10:01:00"), at("10:03:00"))
        assert rows_of(tables.read(MINUTE_TIER), *POWER) == [
            ("2024-01-01 10:01:00", "m1", 1.0, 1), ("2024-01-01 10:02:00", "m1", 2.0, 1),
        ]


def test_late_reading_counts_within_the_lookback_only(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(("10:01:10", "m1", "hall", 1.0)))
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:00")
    tables.upsert(RAW_TIER, raw_rows(("10:01:50", "m1", "hall", 3.0)))
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:03:00")
    assert rows_of(tables.read(MINUTE_TIER), *POWER) == [("2024-01-01 10:01:00", "m1", 2.0, 2)]
    tables.upsert(RAW_TIER, raw_rows(("10:01:55", "m1", "hall", 30.0)))
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:04:00")
    assert rows_of(tables.read(MINUTE_TIER), *POWER) == [("2024-01-01 10:01:00", "m1", 2.0, 2)]


def test_marked_runs_lose_nothing_at_unaligned_clocks(tables, raw_rows):
    seconds = range(0, 300, 10)
    raw = raw_rows(*((f"10:{s // 60:02}:{s % 60:02}", "m1", "hall", float(s)) for s in seconds))
    tables.write(RAW_TIER, raw)
    assert checkpointed_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:05.5") == (at("10:00:00"), at("10:02:00"))
    assert checkpointed_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:40") is None
    assert checkpointed_rollup(tables, MINUTE_JOB, "2024-01-01 10:05:07") == (at("10:02:00"), at("10:05:00"))
    assert rows_of(tables.read(MINUTE_TIER)) == rows_of(rollup_minute(raw))


def test_marks_move_on_empty_windows_and_stay_on_errors(tables, raw_rows, monkeypatch):
    checkpointed_rollup(tables, HOUR_JOB, "2024-01-01 10:00:30")
    assert tables.read_mark(HOUR_JOB.job) == at("10:00:00")
    monkeypatch.setattr(type(tables), "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        checkpointed_rollup(tables, HOUR_JOB, "2024-01-01 12:00:30")
    assert tables.read_mark(HOUR_JOB.job) == at("10:00:00")
    tables.reset_job(HOUR_JOB.job)
    assert tables.read_mark(HOUR_JOB.job) is None


@pytest.mark.parametrize("step", [None, timedelta(hours=2)])
def test_backfill(tables, raw_rows, step):
    raw = raw_rows(*((f"{h:02}:{m:02}:00", f"m{m % 2}", "hall", float(h + m)) for h in range(8, 13) for m in range(0, 60, 7)))
    tables.write(RAW_TIER, raw)
    backfill(tables, "2024-01-01 08:30:00", "2024-01-01 12:15:00", step)
    minutes = rollup_minute(raw)
    assert rows_of(tables.read(MINUTE_TIER)) == rows_of(minutes)
    assert rows_of(tables.read(HOUR_TIER)) == rows_of(rollup_hour(minutes))


def test_retention_job(tables, raw_rows, tier_rows):
    tables.write(RAW_TIER, raw_rows(("10:00:00", "m1")))
    tables.write(MINUTE_TIER, tier_rows(("10:00:00", "m1", "hall", 1.0, 1.0, 6)))
    assert run_retention(tables, "2024-01-15 10:00:00") == {"energy_minute": True}
    assert tables.read(MINUTE_TIER).count() == 1
    run_retention(tables, "2024-01-15 10:00:01")
    assert tables.read(MINUTE_TIER).isEmpty()
    assert run_retention(tables, "2024-02-15", {"energy_raw": 14, "energy_minute": 30}) == {
        "energy_raw": True, "energy_minute": True,
    }
    assert tables.read(RAW_TIER).isEmpty()


def test_rollup_into_other_tables(spark, tables, raw_rows, tmp_path):
    tables.write(RAW_TIER, raw_rows(("10:00:10", "m1")))
    other = TierTables(spark, str(tmp_path / "other"))
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:01:00", into=other)
    assert tables.read(MINUTE_TIER).isEmpty()
    assert other.read(MINUTE_TIER).count() == 1


def test_custom_bucket_width(tables, raw_rows):
    from dataclasses import replace

    tables.write(RAW_TIER, raw_rows(("10:01:00", "m1", "hall", 1.0), ("10:04:00", "m1", "hall", 3.0)))
    wide = replace(MINUTE_JOB, bucket=timedelta(minutes=5), lookback=timedelta(minutes=10), options={"with_count": True})
    run_rollup(tables, wide, "2024-01-01 10:06:00")
    assert rows_of(tables.read(MINUTE_TIER), *POWER) == [("2024-01-01 10:00:00", "m1", 2.0, 2)]


def test_ingest_repeats_without_copies(spark, tables, tmp_path):
    reading = {"machine_id": "m1", "location": "hall", "power_kw": 1, "voltage_v": 2, "current_a": 3,
               "energy_kwh": 4, "power_factor": 0.5, "timestamp": "2024-01-01T10:00:00Z"}
    payloads = [(json.dumps(reading), 1), (json.dumps(reading | {"power_kw": 9}), 2), ("{", 3)]
    messages = spark.createDataFrame(
        [("energy/m1/data", p, at(f"10:00:0{s}")) for p, s in payloads],
        "topic string, payload string, received_at timestamp",
    )
    path = str(tmp_path / "quarantine")
    for _ in range(2):
        ingest_batch(tables, messages, path, "7")
        assert rows_of(tables.read(RAW_TIER), "power_kw") == [(9.0,)]
        assert rows_of(spark.read.parquet(path), "payload", "reject_reason") == [("{", "bad_json")]
    ingest_batch(tables, messages.filter(F.col("payload") == "{"), path, "8")
    assert spark.read.parquet(path).count() == 2


def test_stored_reports_prune(spark, tables, tier_rows):
    tables.write(HOUR_TIER, tier_rows(*((f"2024-01-{d:02}T10:00:00", "m1", "hall", 1.0, 1.0, 1) for d in range(1, 11))))
    report = stored.hourly_report(tables, "2024-01-10 12:00:00", days=2)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "date#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert report.count() == 2


def test_upkeep_gathers_yesterday(tables, raw_rows):
    for second in range(3):
        tables.upsert(RAW_TIER, raw_rows((f"10:00:0{second}", "m1")))
    folder = Path(tables.path(RAW_TIER))
    assert len(list(folder.rglob("*.parquet"))) == 3
    run_upkeep(tables, "2024-01-02 03:00:00")
    assert len(list(folder.rglob("*.parquet"))) == 1 and tables.read(RAW_TIER).count() == 3
