from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import functions as F

from millrace.operators.reports import (
    current_hour,
    daily_summary,
    energy_share,
    hourly_energy,
    latest_reading,
    machine_comparison,
    peak_hour_flag,
    power_factor_alert,
    total_power,
)
from millrace.operators.scope import since, today, today_so_far
from millrace.operators.sections import dense_hourly_grid
from millrace.plans.dashboard import Sections, dashboard_of, merge_dashboard, write_dashboard
from millrace.schemas import HOUR, HOUR_TIER, MINUTE_TIER, RAW_TIER
from tests.conftest import rows_of

NOW = "2024-01-01 10:00:30"


def text_of(document) -> str:
    return "".join(r.text for r in document.collect())


def filled(tables, raw_rows, tier_rows):
    tables.write(RAW_TIER, raw_rows(
        ("10:00:00", "m2", "yard", 2.0), ("10:00:10", "m1", "hall", 12.454), ("09:59:40", "m1", "hall", 99.0),
        ("09:59:00", "m9", "hall", 5.0), ("10:00:20", "m3", "hall", None),
    ))
    tables.write(MINUTE_TIER, tier_rows(
        ("09:00:00", "m1", "hall", 1.0, 1.00049, 6), ("09:01:00", "m2", "yard", 1.0, 1.00051, 6),
        ("09:02:00", "m1", "yard", 1.0, 0.0, 6), ("10:30:00", "m1", "hall", 1.0, 50.0, 6),
    ))
    tables.write(HOUR_TIER, tier_rows(
        ("09:00:00", "m2", "yard", 1.0, 1.23456, 360), ("10:00:00", "m1", "hall", 1.0, 2.0, 360),
        ("10:00:00", "m1", "yard", 1.0, 0.5, 360), ("10:00:00", "m2", "yard", 1.0, 3.0, 360),
        ("2023-12-31T23:00:00", "m1", "hall", 1.0, 9.0, 360), ("2024-01-02T00:00:00", "m1", "hall", 1.0, 9.0, 360),
    ))


def test_document(tables, raw_rows, tier_rows, tmp_path):
    filled(tables, raw_rows, tier_rows)
    document = dashboard_of(tables, NOW)
    assert json.loads(text_of(document)) == {
        "generated_at": "2024-01-01T10:00:30.000Z",
        "realtime": {
            "total_power_kw": 14.45,
            "machines": [
                {"machine_id": "m1", "location": "hall", "power_kw": 12.454, "voltage_v": 220, "current_a": 5,
                 "power_factor": 0.9, "last_seen": "2024-01-01T10:00:10.000Z"},
                {"machine_id": "m2", "location": "yard", "power_kw": 2, "voltage_v": 220, "current_a": 5,
                 "power_factor": 0.9, "last_seen": "2024-01-01T10:00:00.000Z"},
                {"machine_id": "m3", "location": "hall", "power_kw": 0, "voltage_v": 220, "current_a": 5,
                 "power_factor": 0.9, "last_seen": "2024-01-01T10:00:20.000Z"},
            ],
        },
        "line_chart": {
            "title": "Konsumsi Energi Per Jam",
            "labels": ["09:00", "10:00"],
            "datasets": [{"label": "m2", "data": [1.235, 3.0]}, {"label": "m1", "data": [0.0, 2.5]}],
        },
        "pie_chart": {
            "title": "Distribusi Konsumsi Per Mesin — Hari Ini", "labels": ["m2", "m1"], "values": [1.001, 1.0], "unit": "kWh",
        },
    }
    path = tmp_path / "document"
    write_dashboard(document, str(path))
    written = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert json.loads(written) == json.loads(text_of(document))


def test_sections_without_rows_keep_their_titles(tables):
    document = json.loads(text_of(dashboard_of(tables, NOW)))
    assert document["realtime"] == {"total_power_kw": 0, "machines": []}
    assert document["line_chart"] == {"title": "Konsumsi Energi Per Jam", "labels": [], "datasets": []}
    assert document["pie_chart"]["title"] and document["pie_chart"]["values"] == []


def test_failed_sections_take_their_defaults(spark, tables, raw_rows, tier_rows):
    filled(tables, raw_rows, tier_rows)
    day = Path(tables.path(HOUR_TIER)) / "date=2024-01-01"
    for file in day.glob("*.parquet"):
        (day / ".crc").unlink(missing_ok=True)
        file.write_bytes(b"no parquet")
    document = json.loads(text_of(dashboard_of(tables, NOW)))
    assert document["line_chart"] == {"title": "", "labels": [], "datasets": []}
    assert document["pie_chart"]["labels"] == ["m2", "m1"]
    empty = json.loads(text_of(merge_dashboard(spark, Sections(None, None, None), NOW)))
    assert empty == {
        "generated_at": "2024-01-01T10:00:30.000Z",
        "realtime": {"total_power_kw": 0, "machines": []},
        "line_chart": {"title": "", "labels": [], "datasets": []},
        "pie_chart": {"title": "", "labels": [], "values": [], "unit": "kWh"},
    }


def test_large_fleet_is_written_by_many_tasks(spark):
    latest = spark.range(20_000).selectExpr(
        "concat('m', lpad(id, 6, '0')) as machine_id", "'hall' as location", "1.0D as power_kw", "2.0D as voltage_v",
        "3.0D as current_a", "0.5D as power_factor", "timestamp_seconds(id) as last_seen",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        document = merge_dashboard(spark, Sections(latest, None, None), NOW)
        assert document.rdd.getNumPartitions() > 1
        parsed = json.loads(text_of(document))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parsed["realtime"]["total_power_kw"] == 20_000
    ids = [m["machine_id"] for m in parsed["realtime"]["machines"]]
    assert len(ids) == 20_000 and ids == sorted(ids)


def test_quotes_in_names_stay_json(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(("10:00:00", 'm"1\\', "ha,ll")))
    machines = json.loads(text_of(dashboard_of(tables, NOW)))["realtime"]["machines"]
    assert [(m["machine_id"], m["location"]) for m in machines] == [('m"1\\', "ha,ll")]


def test_no_cross_join_and_no_python(spark, raw_rows, tier_rows):
    hour = tier_rows(("09:00:00", "m1", "hall", 1.0, 1.0, 360))
    plan = dense_hourly_grid(hourly_energy(hour, NOW))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Cartesian", "NestedLoop", "Python"))


def test_moved_machine_is_two_rows_of_status_and_one_of_share(raw_rows, tier_rows):
    raw = raw_rows(("09:59:50", "m1", "hall", 1.0), ("10:00:00", "m1", "yard", 2.0))
    assert rows_of(latest_reading(raw, NOW), "location", "latest_power_kw") == [("hall", 1.0), ("yard", 2.0)]
    by_machine = latest_reading(raw, NOW, measures=("power_kw",), by=("machine_id",))
    assert rows_of(by_machine, "machine_id", "latest_power_kw") == [("m1", 2.0)]
    minutes = tier_rows(("09:00:00", "m1", "hall", 1.0, 1.0, 6), ("09:01:00", "m1", "yard", 1.0, 2.0, 6))
    assert rows_of(energy_share(minutes, NOW)) == [("m1", 3.0)]


def test_scopes(raw_rows):
    raw = raw_rows(("2023-12-31T23:59:59", "a"), ("00:00:00", "b"), ("10:00:00", "c"), ("10:00:30", "d"), ("23:00:00", "e"))
    names = lambda df: "".join(r[0] for r in rows_of(df, "machine_id"))
    assert names(since(raw, NOW, HOUR)) == "cde"
    assert names(today(raw, NOW)) == "bcde"
    assert names(today_so_far(raw, NOW)) == "bc"
    assert names(current_hour(raw, NOW)) == "cde"


def test_report_order(tier_rows):
    minutes = tier_rows(
        ("10:00:00", "m2", "hall", 1.0, 5.0, 6), ("10:00:00", "m1", "hall", 1.0, 5.0, 6), ("10:00:00", "m3", "hall", 1.0, 7.0, 6),
    ).withColumn("avg_power_factor", F.expr("if(machine_id = 'm1', 0.89, if(machine_id = 'm2', 0.5, 0.9))"))
    assert [r.machine_id for r in machine_comparison(minutes, NOW).collect()] == ["m3", "m1", "m2"]
    assert [r.machine_id for r in power_factor_alert(minutes, NOW).collect()] == ["m2", "m1"]


def test_daily_summary_and_total(tier_rows, raw_rows):
    hours = tier_rows(("00:00:00", "m1", "hall", 1.0, 1.0, 300), ("23:00:00", "m1", "hall", 3.0, 2.0, 360))
    row = daily_summary(hours, NOW).first()
    assert (row.total_energy_kwh, row.avg_power_kw, row.peak_power_kw, row.total_samples) == (3.0, 2.0, 3.0, 660)
    assert total_power(raw_rows().select("power_kw")).first()[0] == 0.0


def test_peak_hours(tier_rows):
    hours = tier_rows(
        ("2024-01-01T00:00:00", "m1", "hall", 10.0, 1.0, 1), ("2024-01-20T00:00:00", "m1", "hall", 2.0, 1.0, 1),
        ("2024-02-10T00:00:00", "m1", "hall", 2.0, 1.0, 1),
    )
    flags = peak_hour_flag(hours).orderBy("time").collect()
    assert [(r.rolling_avg, r.peak_hour_flag) for r in flags] == [(10.0, 1), (6.0, 0), (2.0, 1)]
