from __future__ import annotations

import json

from millrace.operators.rollup import rollup_hour, rollup_minute
from millrace.schemas import HOUR_TIER, MINUTE_TIER, RAW_SCHEMA, RAW_TIER
from millrace.sources.messages import read_messages
from millrace.streaming.rollups import (
    dropped_late_rows,
    hour_stream,
    ingest_stream,
    minute_stream,
    start_minute_updates,
    start_rollup,
)
from tests.conftest import at, rows_of

LAST = ("2024-01-01T13:00:00", "sentinel")


def land(rows, folder):
    rows.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_streams_equal_batch_on_closed_buckets(spark, tables, raw_rows, tmp_path):
    times = [(f"{h:02}:{m:02}:{s:02}", f"m{s % 3}", "hall", float(m)) for h in (9, 10, 11) for m in range(0, 60, 9) for s in (0, 25, 50)]
    everything = raw_rows(*times, LAST)
    for hour in ("09", "10", "11"):
        land(raw_rows(*(t for t in times if t[0].startswith(hour))), tmp_path / "raw")
    land(raw_rows(LAST), tmp_path / "raw")
    minutes = rollup_minute(everything)

    minute_query = start_rollup(minute_stream(stream(spark, tmp_path / "raw")), tables, MINUTE_TIER, str(tmp_path / "c1"))
    minute_query.awaitTermination()
    assert rows_of(tables.read(MINUTE_TIER)) == rows_of(minutes.filter("machine_id <> 'sentinel'"))

    chained = hour_stream(minute_stream(stream(spark, tmp_path / "raw")))
    start_rollup(chained, tables, HOUR_TIER, str(tmp_path / "c2")).awaitTermination()
    assert rows_of(tables.read(HOUR_TIER)) == rows_of(rollup_hour(minutes).filter("machine_id <> 'sentinel'"))


def test_restart_goes_on_and_late_rows_are_dropped(spark, tables, raw_rows, tmp_path):
    def run():
        query = start_rollup(minute_stream(stream(spark, tmp_path / "raw")), tables, MINUTE_TIER, str(tmp_path / "c"))
        query.awaitTermination()
        return query

    land(raw_rows(("10:00:10", "m1", "hall", 1.0), ("10:01:50", "m1", "hall", 5.0)), tmp_path / "raw")
    run()
    assert rows_of(tables.read(MINUTE_TIER)) == []
    # One minute late, still in time: the bucket closes when an event of 10:02 has been seen.
    land(raw_rows(("10:00:20", "m1", "hall", 3.0)), tmp_path / "raw")
    land(raw_rows(("10:09:00", "m1", "hall", 7.0)), tmp_path / "raw")
    run()
    land(raw_rows(("10:00:30", "m1", "hall", 90.0)), tmp_path / "raw")
    land(raw_rows(("10:20:00", "m1", "hall", 7.0)), tmp_path / "raw")
    query = run()
    assert dropped_late_rows(query) == 1
    assert rows_of(tables.read(MINUTE_TIER), "time", "avg_power_kw", "sample_count") == [
        ("2024-01-01 10:00:00", 2.0, 2), ("2024-01-01 10:01:00", 5.0, 1), ("2024-01-01 10:09:00", 7.0, 1),
    ]


def test_update_mode_writes_open_buckets(spark, tables, raw_rows, tmp_path):
    land(raw_rows(("10:00:10", "m1", "hall", 1.0)), tmp_path / "raw")
    start_minute_updates(stream(spark, tmp_path / "raw"), tables, str(tmp_path / "c")).awaitTermination()
    assert rows_of(tables.read(MINUTE_TIER), "avg_power_kw") == [(1.0,)]
    land(raw_rows(("10:00:20", "m1", "hall", 3.0)), tmp_path / "raw")
    start_minute_updates(stream(spark, tmp_path / "raw"), tables, str(tmp_path / "c")).awaitTermination()
    assert rows_of(tables.read(MINUTE_TIER), "avg_power_kw") == [(2.0,)]


def test_ingest_stream(spark, tables, tmp_path):
    reading = {"machine_id": "m1", "location": "hall", "power_kw": 1, "voltage_v": 2, "current_a": 3,
               "energy_kwh": 4, "power_factor": 0.5, "timestamp": 1704103200000}
    folder, bad = str(tmp_path / "landing"), str(tmp_path / "quarantine")
    schema = "topic string, payload string, received_at timestamp"

    def arrive(*payloads):
        rows = [("energy/m1/data", p, at(f"10:00:0{i}")) for i, p in enumerate(payloads)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)
        messages = read_messages(spark, folder, stream=True)
        ingest_stream(messages, tables, bad, str(tmp_path / "c")).awaitTermination()

    arrive(json.dumps(reading), "junk")
    arrive(json.dumps(reading | {"power_kw": 2}), json.dumps(reading | {"machine_id": None}))
    assert rows_of(tables.read(RAW_TIER), "time", "power_kw") == [("2024-01-01 10:00:00", 2.0)]
    assert rows_of(spark.read.parquet(bad), "reject_reason") == [("bad_json",), ("missing:machine_id",)]
