from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.merge import dedupe_last, merge_last
from millrace.schemas import HOUR_TIER, KEY, MINUTE_TIER, RAW_TIER
from millrace.sources.line_protocol import from_lines, read_line_protocol, rejected_lines, to_lines, write_line_protocol
from millrace.sources.tiers import TierTables
from tests.conftest import at, rows_of


def partitions(tables: TierTables, tier) -> list[str]:
    root = Path(tables.path(tier))
    return sorted(str(p.parent.relative_to(root)) for p in root.rglob("*.parquet"))


def test_scan_prunes_partitions_and_pushes_time(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(
        ("2024-01-01T22:30:00", "m1"), ("2024-01-01T23:59:59.999999", "m1"), ("2024-01-02T00:00:00", "m1"),
        ("2024-01-02T05:00:00", "m1"),
    ))
    assert partitions(tables, RAW_TIER) == [
        "date=2024-01-01/hour_of_day=22", "date=2024-01-01/hour_of_day=23",
        "date=2024-01-02/hour_of_day=0", "date=2024-01-02/hour_of_day=5",
    ]
    scan = tables.read(RAW_TIER, "2024-01-01 23:00:00", "2024-01-02 05:00:00")
    assert rows_of(scan, "time") == [("2024-01-01 23:59:59.999999",), ("2024-01-02 00:00:00",)]
    files = scan.select(F.input_file_name()).distinct().count()
    assert files == 2
    plan = scan.select("power_kw")._jdf.queryExecution().explainString(
        scan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(time" in plan
    assert "ReadSchema: struct<time:timestamp,power_kw:double>" in plan


def test_scan_of_a_tier_never_written(tables):
    assert tables.read(MINUTE_TIER, "2024-01-01").isEmpty()


def test_catalog_tables(spark, tables, raw_rows):
    assert tables.create("plant") == tables.create("plant")
    tables.write(RAW_TIER, raw_rows(("10:00:00", "m1")))
    tables.refresh("plant")
    assert spark.sql("SELECT machine_id, date FROM plant.energy_raw").first().machine_id == "m1"
    tables.write(RAW_TIER, raw_rows(("11:00:00", "m2")))
    tables.refresh("plant", (at("11:00:00"), at("13:00:00")))
    assert spark.table("plant.energy_raw").count() == 2
    spark.sql("DROP DATABASE plant CASCADE")


def test_last_arrival_wins_whole(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5.0, "x"), ("a", 2, None, "y"), ("a", None, 3.0, "z"), ("b", None, 1.0, "n"), (None, 1, 1.0, "k")],
        "k string, arrival int, v double, w string",
    )
    assert rows_of(dedupe_last(rows, ["k"], "arrival")) == sorted(
        [("a", 2, None, "y"), ("b", None, 1.0, "n"), (None, 1, 1.0, "k")], key=str
    )


def test_ties_never_mix_rows(spark):
    rows = spark.range(0, 40_000, 1, 16).selectExpr("id % 50 as k", "id % 4 as arrival", "id as a", "cast(id as double) as b", "-id as c")
    last = dedupe_last(rows, ["k"], "arrival")
    assert last.count() == 50
    assert last.filter("a <> b or a <> -c or a % 4 <> arrival or a % 50 <> k").isEmpty()
    assert last.join(rows.groupBy("k").agg(F.max("arrival").alias("top")), "k").filter("arrival < top").isEmpty()


def test_hot_copies_are_cut_before_the_shuffle(spark):
    copies = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as k", "id as arrival", "id as v")
    last = dedupe_last(copies, ["k"], "arrival")
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by") and "SortAggregate" not in plan
    assert last.count() == 20_001
    assert last.filter("k = -1").first().v == 29_997


def test_merge_keeps_null_updates(spark):
    schema = "machine_id string, v double"
    old = spark.createDataFrame([("a", 1.0), ("b", 1.0)], schema)
    new = spark.createDataFrame([("b", None), ("c", 3.0)], schema)
    assert rows_of(merge_last(old, new, ["machine_id"])) == [("a", 1.0), ("b", None), ("c", 3.0)]


def test_upsert_touches_only_its_partitions_and_repeats(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(
        ("09:00:00", "m1"), ("10:00:00", "m1", "hall", 1.0), ("10:00:00", "m1", "yard", 2.0),
    ))
    before = sorted(Path(tables.path(RAW_TIER)).rglob("hour_of_day=9/*.parquet"))
    updates = raw_rows(("10:00:00", "m1", "hall", 8.0), ("2024-01-03T00:00:00", "m1", "hall", 9.0))
    expected = [
        ("2024-01-01 09:00:00", "hall", 1.0), ("2024-01-01 10:00:00", "hall", 8.0),
        ("2024-01-01 10:00:00", "yard", 2.0), ("2024-01-03 00:00:00", "hall", 9.0),
    ]
    for _ in range(2):
        tables.upsert(RAW_TIER, updates)
        assert rows_of(tables.read(RAW_TIER), "time", "location", "power_kw") == expected
    assert sorted(Path(tables.path(RAW_TIER)).rglob("hour_of_day=9/*.parquet")) == before


def test_upsert_orders_copies_by_arrival(tables, raw_rows):
    updates = raw_rows(("10:00:00", "m1", "hall", 1.0), ("10:00:00", "m1", "hall", 2.0))
    updates = updates.withColumn("received_at", F.col("time") + F.make_interval(secs=3 - F.col("power_kw")))
    tables.upsert(RAW_TIER, updates, order_by="received_at")
    assert rows_of(tables.read(RAW_TIER), "power_kw") == [(1.0,)]


def files(tables: TierTables, tier) -> set[Path]:
    return set(Path(tables.path(tier)).rglob("*.parquet"))


def test_upsert_appends_new_keys_and_skips_known_rows(tables, raw_rows):
    first = raw_rows(("09:00:00", "m1"), ("10:00:00", "m1"))
    tables.upsert(RAW_TIER, first)
    written = files(tables, RAW_TIER)
    tables.upsert(RAW_TIER, first)
    assert files(tables, RAW_TIER) == written
    tables.upsert(RAW_TIER, raw_rows(("10:00:00", "m1"), ("10:00:10", "m1"), ("1969-12-31T23:30:00", "m1")))
    assert files(tables, RAW_TIER) > written
    assert tables.read(RAW_TIER).count() == 4
    tables.upsert(RAW_TIER, raw_rows(("10:00:10", "m1", "hall", 7.0), ("10:00:20", "m1"), ("11:00:00", "m1")))
    kept = files(tables, RAW_TIER) & written
    assert [f.parent.name for f in kept] == ["hour_of_day=9"]
    assert rows_of(tables.read(RAW_TIER), "time", "power_kw") == [
        ("1969-12-31 23:30:00", 1.0), ("2024-01-01 09:00:00", 1.0), ("2024-01-01 10:00:00", 1.0),
        ("2024-01-01 10:00:10", 7.0), ("2024-01-01 10:00:20", 1.0), ("2024-01-01 11:00:00", 1.0),
    ]
    before = rows_of(tables.read(RAW_TIER))
    tables.compact(RAW_TIER, at("09:00:00"), at("11:00:00"))
    assert rows_of(tables.read(RAW_TIER)) == before
    assert partitions(tables, RAW_TIER).count("date=2024-01-01/hour_of_day=10") == 1


def test_busy_hour_is_written_by_several_tasks(spark, tables):
    rows = spark.range(200_000).selectExpr(
        "timestamp_micros(1704067200000000 + if(id % 3 = 0, id, id * 100000)) as time", "uuid() as machine_id",
        "'hall' as location", *(f"rand(1) as {c}" for c in ("power_kw", "energy_kwh", "voltage_v", "current_a", "power_factor")),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.write(RAW_TIER, rows.repartition(8))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert partitions(tables, RAW_TIER).count("date=2024-01-01/hour_of_day=0") > 3
    assert tables.read(RAW_TIER).count() == 200_000


def test_crash_between_delete_and_rename_loses_nothing(tables, raw_rows, monkeypatch):
    tables.upsert(RAW_TIER, raw_rows(("10:00:00", "m1", "hall", 1.0), ("10:00:10", "m1", "hall", 1.0)))

    def crash(self, tier, rows):
        self._fs_delete(f"{self.path(tier)}/date=2024-01-01/hour_of_day=10")
        raise RuntimeError("crash")

    with monkeypatch.context() as patched:
        patched.setattr(TierTables, "write", crash)
        with pytest.raises(RuntimeError):
            tables.upsert(RAW_TIER, raw_rows(("10:00:10", "m1", "hall", 5.0)))
    assert tables.read(RAW_TIER).isEmpty()
    tables.upsert(RAW_TIER, raw_rows(("10:00:20", "m1", "hall", 6.0)))
    assert rows_of(tables.read(RAW_TIER), "power_kw") == [(1.0,), (5.0,), (6.0,)]


def test_crashed_merge_keeps_rows_without_a_source(tables, tier_rows, monkeypatch):
    tables.write(HOUR_TIER, tier_rows(("10:00:00", "m1", "hall", 1.0, 1.0, 1), ("11:00:00", "m1", "hall", 2.0, 1.0, 1)))
    updates, window = tier_rows(("11:00:00", "m1", "hall", 5.0, 1.0, 1)), (at("11:00:00"), at("12:00:00"))

    def crash(self, tier, rows):
        self._fs_delete(f"{self.path(tier)}/date=2024-01-01")
        raise RuntimeError("crash")

    with monkeypatch.context() as patched:
        patched.setattr(TierTables, "write", crash)
        with pytest.raises(RuntimeError):
            tables.merge(HOUR_TIER, updates, window)
    tables.merge(HOUR_TIER, updates, window)
    assert rows_of(tables.read(HOUR_TIER), "avg_power_kw") == [(1.0,), (5.0,)]


def test_upsert_of_nothing(tables, raw_rows):
    tables.upsert(RAW_TIER, raw_rows())
    tables.upsert(RAW_TIER, raw_rows((None, "m1")))
    assert tables.read(RAW_TIER).isEmpty()


def test_merge_rewrites_its_window(tables, tier_rows):
    tables.write(HOUR_TIER, tier_rows(("2024-01-01T10:00:00", "m1", "hall", 1.0, 1.0, 1), ("2024-01-02T10:00:00", "m1", "hall", 1.0, 1.0, 1)))
    updates = tier_rows(("2024-01-01T10:00:00", "m1", "hall", 5.0, 1.0, 1), ("2024-01-01T11:00:00", "m1", "hall", 6.0, 1.0, 1))
    tables.merge(HOUR_TIER, updates, (at("10:00:00"), at("12:00:00")))
    assert rows_of(tables.read(HOUR_TIER), "time", "avg_power_kw") == [
        ("2024-01-01 10:00:00", 5.0), ("2024-01-01 11:00:00", 6.0), ("2024-01-02 10:00:00", 1.0),
    ]


def test_upsert_of_many_separate_hours(spark, tables):
    """Every second of 800 hours, a scattered set of partitions in one call."""
    hours = spark.range(0, 800, 2).selectExpr(
        "timestamp_seconds(1704067200 + id * 3600) AS time", "'machine_01' AS machine_id", "'office' AS location",
        "1.0D AS power_kw", "1.0D AS energy_kwh", "1.0D AS voltage_v", "1.0D AS current_a", "1.0D AS power_factor",
    )
    tables.upsert(RAW_TIER, hours)
    tables.upsert(RAW_TIER, hours.withColumn("power_kw", F.when(F.hour("time") < 12, 2.0).otherwise(1.0)))
    power = {r.power_kw: r["count"] for r in tables.read(RAW_TIER).groupBy("power_kw").count().collect()}
    assert power == {2.0: 202, 1.0: 198}


@pytest.mark.parametrize("tier", [MINUTE_TIER, HOUR_TIER])
def test_retention_keeps_the_cutoff_itself(tables, tier_rows, tier):
    times = ("2024-01-01T05:00:00", "2024-01-02T11:00:00", "2024-01-02T12:29:59.999999", "2024-01-02T12:30:00", "2024-01-03T00:00:00")
    tables.write(tier, tier_rows(*((t, "m1", "hall", 1.0, 1.0, 6) for t in times)))
    for _ in range(2):
        assert tables.apply_retention(tier, 14, "2024-01-16 12:30:00.9")
        assert rows_of(tables.read(tier), "time") == [("2024-01-02 12:30:00",), ("2024-01-03 00:00:00",)]


def test_retention_may_empty_the_boundary_partition(tables, tier_rows):
    tables.write(MINUTE_TIER, tier_rows(("2024-01-02T12:10:00", "m1", "hall", 1.0, 1.0, 6)))
    assert tables.apply_retention(MINUTE_TIER, 1, "2024-01-03 12:30:00")
    assert tables.read(MINUTE_TIER).isEmpty()
    assert partitions(tables, MINUTE_TIER) == []


def test_retention_failure_is_logged(tables, caplog):
    broken = Path(tables.path(MINUTE_TIER)) / "date=2024-01-02" / "hour_of_day=x"
    broken.mkdir(parents=True)
    assert not tables.apply_retention(MINUTE_TIER, 1, "2024-01-03 12:30:00")
    assert "retention of energy_minute" in caplog.text


def test_marks(tables):
    assert tables.read_mark("job") is None
    tables.write_mark("job", at("10:00:00"))
    tables.write_mark("job", at("10:05:00"))
    assert tables.read_mark("job") == at("10:05:00")
    tables.reset_job("job")
    assert tables.read_mark("job") is None


def test_line_protocol_round_trip(spark, tier_rows, tmp_path):
    rows = tier_rows(
        ("10:00:00.000001", "m 1,a=b", "hall a", 1.0e-5, 1.2345678901e10, 6),
        ("1969-12-31T23:59:59.999999", "m2", "x", -0.0, 0.1 + 0.2, 0),
    )
    path = str(tmp_path / "lines")
    write_line_protocol(rows, path, MINUTE_TIER)
    back = read_line_protocol(spark, path, MINUTE_TIER)
    assert rows_of(back, digits=None) == rows_of(rows, digits=None)


def test_line_protocol_text(spark, tier_rows, raw_rows):
    line = to_lines(tier_rows(("10:00:00", "m 1", "hall", 2.0, 0.5, 6)), MINUTE_TIER).first().value
    assert line == (
        r"energy_minute,machine_id=m\ 1,location=hall avg_power_kw=2.0,sum_energy_kwh=0.5,avg_voltage_v=220.0,"
        "avg_current_a=5.0,avg_power_factor=0.9,min_power_kw=2.0,max_power_kw=2.0,sample_count=6i 1704103200000000000"
    )
    lines = spark.createDataFrame(
        [("energy_raw,machine_id=m1,location=hall power_kw=1.5,power_factor=0.9 1719652800000",), ("other,a=b c=1 1",)],
        "value string",
    )
    row = from_lines(lines, RAW_TIER, "ms").collect()
    assert [(r.machine_id, r.power_kw, r.voltage_v) for r in row] == [("m1", 1.5, None)]
    assert rows_of(from_lines(lines, RAW_TIER, "ms"), "time") == [("2024-06-29 09:20:00",)]


def test_bad_lines_are_refused_one_by_one(spark):
    lines = spark.createDataFrame(
        [(f"energy_raw,machine_id=m{i} {rest}",) for i, rest in enumerate(
            ("power_kw=1", "power_kw=1,power_kw=2 5", "power_kw=NaN 5", "power_kw=x 5", "other=1 5", "power_kw=1 soon", "power_kw=1 5 6"))]
        + [("",), ("# energy_raw",), (None,)],
        "value string",
    )
    reasons = {r.value[23]: r.reject_reason for r in rejected_lines(lines, RAW_TIER, "s").collect()}
    assert reasons == {"0": "no time", "2": "bad number", "3": "bad number", "4": "no fields", "5": "bad time", "6": "too many parts"}
    assert rows_of(from_lines(lines, RAW_TIER, "s"), "machine_id", "power_kw") == [("m1", 2.0)]
    filled = from_lines(lines, RAW_TIER, "s", default_time="2024-01-01 10:00:00")
    assert rows_of(filled, "machine_id", "time") == [("m0", "2024-01-01 10:00:00"), ("m1", "1970-01-01 00:00:05")]


def test_export_leaves_out_what_the_form_lacks(tier_rows):
    rows = tier_rows(("10:00:00", "m1", "", float("nan"), 1.0, 1)).union(
        tier_rows(("10:00:00", "m2", "hall", 1.0, 1.0, 1)).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in KEY else f.name for f in MINUTE_TIER.schema.fields)))
    (line,) = to_lines(rows, MINUTE_TIER).collect()
    assert line.value.startswith("energy_minute,machine_id=m1 sum_energy_kwh=1.0,") and "NaN" not in line.value


def test_keys_are_the_tier_columns():
    assert set(KEY) <= set(RAW_TIER.schema.names)
