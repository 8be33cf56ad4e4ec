"""Late readings, versions of rows, change notes, counts and gaps."""

from __future__ import annotations

import json
from datetime import timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from millrace.functions.clock import from_unix_nanos, unix_nanos
from millrace.operators.cleanse import REASONS, cleanse, reject_counts
from millrace.operators.gaps import gap_report
from millrace.operators.merge import dedupe_last
from millrace.operators.rollup import rollup_hour, rollup_minute
from millrace.plans.dashboard import HEAD, PublishedDashboard
from millrace.plans.jobs import HOUR_JOB, MINUTE_JOB, checkpointed_rollup, ingest_batch, run_rollup
from millrace.schemas import HOUR_TIER, KEY, MINUTE_TIER, RAW_TIER
from millrace.sources import tiers as tier_module
from millrace.sources.messages import MESSAGE_SCHEMA
from millrace.streaming.rollups import LateSink, ingest_stream
from tests.conftest import at, rows_of

POWER = ("time", "machine_id", "avg_power_kw", "sample_count")


def run_both(tables, now, **options):
    for job in (MINUTE_JOB, HOUR_JOB):
        run_rollup(tables, job, now, **options)


def test_row_three_hours_late_changes_its_minute_and_hour(tables, raw_rows):
    early = raw_rows(("10:01:10", "m1", "hall", 1.0), ("10:01:20", "m2", "hall", 5.0), ("10:30:00", "m1", "hall", 2.0))
    tables.upsert(RAW_TIER, early, batch="a")
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:00", repair=True)
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:31:00", repair=True)
    run_rollup(tables, HOUR_JOB, "2024-01-01 11:00:00", repair=True)
    late = raw_rows(("10:01:50", "m1", "hall", 3.0), ("10:45:00", None, None, 7.0))
    tables.upsert(RAW_TIER, late, batch="b")
    run_both(tables, "2024-01-01 13:05:00", repair=True)
    everything = rollup_minute(early.union(late))
    assert rows_of(tables.read(MINUTE_TIER)) == rows_of(everything)
    assert rows_of(tables.read(HOUR_TIER)) == rows_of(rollup_hour(everything))
    assert tables.read_changes(RAW_TIER)[0] == tables.read_changes(MINUTE_TIER)[0] == []


def test_only_touched_buckets_are_made_again(tables, raw_rows, tier_rows):
    tables.upsert(RAW_TIER, raw_rows(("10:01:10", "m1"), ("10:01:10", "m2"), ("10:02:10", "m1")))
    marked = tier_rows(*((t, m, "hall", 99.0, 9.0, 1) for t, m in (("10:01:00", "m1"), ("10:01:00", "m2"), ("10:02:00", "m1"))))
    tables.write(MINUTE_TIER, marked)
    tables.upsert(RAW_TIER, raw_rows(("10:01:50", "m1", "hall", 3.0)), batch="late")
    run_rollup(tables, MINUTE_JOB, "2024-01-01 14:00:00", repair=True)
    assert rows_of(tables.read(MINUTE_TIER), *POWER) == [
        ("2024-01-01 10:01:00", "m1", 2.0, 2), ("2024-01-01 10:01:00", "m2", 99.0, 1), ("2024-01-01 10:02:00", "m1", 99.0, 1),
    ]


def test_repair_reads_the_touched_partitions_only(tables, raw_rows):
    tables.write(RAW_TIER, raw_rows(*((f"{h:02}:01:10", f"m{h}") for h in range(24))))
    buckets = raw_rows(("05:01:00", "m5"), ("07:01:00", "m5")).select(*KEY)
    rows = tables.read_buckets(RAW_TIER, buckets)
    assert len({f.split("date=")[1] for f in rows.inputFiles()}) == 24  # files of the table
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and rows_of(rows, "machine_id") == [("m5",)]
    scan = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "IN" in scan.upper() or "INSET" in scan.upper()


def test_marked_jobs_repair_behind_their_mark(tables, raw_rows):
    first, second = raw_rows(("10:00:10", "m1", "hall", 1.0)), raw_rows(("10:00:20", "m1", "hall", 3.0), ("10:03:00", "m1", "hall", 4.0))
    tables.write_mark(MINUTE_JOB.job, at("10:00:00"))
    tables.upsert(RAW_TIER, first, batch="1")
    checkpointed_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:10", repair=True)
    tables.upsert(RAW_TIER, second, batch="2")
    checkpointed_rollup(tables, MINUTE_JOB, "2024-01-01 10:04:10", repair=True)
    assert rows_of(tables.read(MINUTE_TIER)) == rows_of(rollup_minute(first.union(second)))


def test_notes_outlive_a_crash(tables, raw_rows, monkeypatch):
    run_rollup(tables, MINUTE_JOB, "2024-01-01 10:02:00", repair=True)
    whole = type(tables)._apply

    def crash(self, *args):
        whole(self, *args)
        raise OSError("lost")

    monkeypatch.setattr(type(tables), "_apply", crash)
    with pytest.raises(OSError):
        tables.upsert(RAW_TIER, raw_rows(("10:01:10", "m1")), batch="a")
    monkeypatch.undo()
    assert tables.read_changes(RAW_TIER)[0] == []  # its rows might not be in yet
    tables.upsert(RAW_TIER, raw_rows(("12:01:10", "m2")), batch="b")
    run_rollup(tables, MINUTE_JOB, "2024-01-01 13:00:00", repair=True)
    assert [r[1] for r in rows_of(tables.read(MINUTE_TIER), *POWER)] == ["m1", "m2"]


def test_a_crashed_repair_is_repeated(tables, raw_rows, monkeypatch):
    tables.upsert(RAW_TIER, raw_rows(("10:01:10", "m1")), batch="a")
    monkeypatch.setattr(type(tables), "read_buckets", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_rollup(tables, MINUTE_JOB, "2024-01-01 13:00:00", repair=True)
    monkeypatch.undo()
    run_rollup(tables, MINUTE_JOB, "2024-01-01 13:00:00", repair=True)
    assert tables.read(MINUTE_TIER).count() == 1 and tables.read_changes(RAW_TIER)[0] == []


def versioned(raw_rows, power, minute, partition=None, offset=None, time="10:00:00"):
    rows = raw_rows((time, "m1", None, power))
    return rows.withColumns({
        "received_at": F.lit(at(f"11:{minute:02}:00")), "source_partition": F.lit(partition).cast("int"), "source_offset": F.lit(offset).cast("long"),
    })


def test_batches_in_any_order_give_one_table(spark, raw_rows, tmp_path):
    batches = [versioned(raw_rows, 1.0, 1), versioned(raw_rows, 5.0, 9, 0, 7), versioned(raw_rows, 3.0, 9, 0, 8)]
    for k, order in enumerate(permutations(batches)):
        tables = tier_module.TierTables(spark, str(tmp_path / str(k)))
        for batch in order:
            tables.upsert(RAW_TIER, batch)
        assert rows_of(tables.read(RAW_TIER), "power_kw") == [(3.0,)]


def test_an_older_copy_changes_nothing(tables, raw_rows):
    tables.upsert(RAW_TIER, versioned(raw_rows, 5.0, 9))
    before = sorted(tables.read(RAW_TIER).inputFiles())
    tables.upsert(RAW_TIER, versioned(raw_rows, 1.0, 2))
    assert sorted(tables.read(RAW_TIER).inputFiles()) == before
    # A correction without arrival goes in, and gives way to whatever arrives after it.
    tables.upsert(RAW_TIER, raw_rows(("10:00:00", "m1", None, 8.0)))
    assert rows_of(tables.read(RAW_TIER), "power_kw") == [(8.0,)]
    tables.upsert(RAW_TIER, versioned(raw_rows, 1.0, 2))
    assert rows_of(tables.read(RAW_TIER), "power_kw") == [(1.0,)]


def test_versions_outlive_rewrites(tables, raw_rows):
    tables.upsert(RAW_TIER, versioned(raw_rows, 5.0, 9).union(versioned(raw_rows, 5.0, 9, time="10:20:00")))
    tables.upsert(RAW_TIER, versioned(raw_rows, 6.0, 10, time="10:20:00"))
    tables.compact(RAW_TIER, at("10:00:00"), at("11:00:00"))
    tables.apply_retention(RAW_TIER, 1, "2024-01-02 10:10:00")
    tables.upsert(RAW_TIER, versioned(raw_rows, 1.0, 9, time="10:20:00"))
    assert rows_of(tables.read(RAW_TIER, versions=True), "time", "power_kw", "received_at") == [
        ("2024-01-01 10:20:00", 6.0, "2024-01-01 11:10:00")
    ]


def test_ties_are_settled(spark):
    rows = spark.createDataFrame([("k", 1, float(v), "x") for v in range(40)] + [("k", None, 99.0, "y"), (None, 1, 1.0, None)], "k string, at int, v double, w string")
    for seed in range(20):
        shuffled = rows.orderBy(F.rand(seed)).repartition(5)
        assert rows_of(dedupe_last(shuffled, ["k"], ["at"])) == [("k", 1, 39.0, "x"), (None, 1, 1.0, None)]


def test_ingest_counts_equal_a_second_read(spark, tables):
    good = dict(machine_id="m1", location="hall", power_kw=1, voltage_v=2, current_a=3, energy_kwh=4, power_factor=0.5)
    payloads = [json.dumps(good), json.dumps(good | {"power_kw": "n/a"}), json.dumps(good | {"location": None}), "{", None, json.dumps(good | {"timestamp": "2030-01-01T00:00:00Z"})]
    messages = spark.createDataFrame([("energy/m1/data", p, at(f"10:00:0{k}")) for k, p in enumerate(payloads)], MESSAGE_SCHEMA)
    counts = ingest_batch(tables, messages, f"{tables.root}/q", max_future_skew=timedelta(days=1))
    expected = {r[0]: r[1] for r in reject_counts(cleanse(messages, timedelta(days=1))).collect()}
    assert counts.rejected == expected and set(expected) <= set(REASONS)
    assert counts.messages == 6 and counts.valid == 6 - sum(expected.values()) == tables.read(RAW_TIER).count()


def test_ingest_parses_once(spark, tables):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def payload(k):
        calls.add(1)
        return '{"machine_id": "m1"'

    messages = spark.range(50).select(F.lit("t").alias("topic"), payload("id").alias("payload"), F.lit(at("10:00:00")).alias("received_at"))
    assert ingest_batch(tables, messages, f"{tables.root}/q").rejected == {"bad_json": 50}
    assert calls.value == 50


def test_late_sink(spark, tables, raw_rows, tmp_path):
    def land(name, *times):
        sent = [(f"2024-01-01T{t}Z", at(t)) for t in times]
        payload = lambda t: json.dumps(dict(machine_id="m1", location="hall", timestamp=t, power_kw=1, voltage_v=2, current_a=3, energy_kwh=4, power_factor=0.5))
        rows = [("energy/m1/data", payload(text), received) for text, received in sent]
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    sink = LateSink(spark, str(tmp_path / "late"), lateness=timedelta(minutes=2))

    def run():
        from millrace.sources.messages import read_messages

        stream = read_messages(spark, str(tmp_path / "in"), stream=True)
        ingest_stream(stream, tables, str(tmp_path / "q"), str(tmp_path / "checkpoint"), late=sink).awaitTermination()

    land("a", "10:00:10", "10:20:30")  # edge 10:18:30
    run()
    land("b", "10:16:59", "10:17:00", "10:17:59", "10:18:00", "10:30:00")  # edge 10:28:00
    run()
    land("c", "10:19:00", "10:27:00", "10:27:59")
    run()
    assert [r[0][11:] for r in rows_of(sink.read(), "time")] == ["10:16:59", "10:17:00", "10:17:59", "10:19:00", "10:27:00", "10:27:59"]
    assert tables.read(RAW_TIER).count() == 10
    # The last batch again, by its number: the same rows, once.
    last = sink.read().agg(F.max("batch")).first()[0]
    stream = sink.read().first()["stream"]
    again = sink.read().filter(F.col("batch") == last).drop("stream", "batch")
    sink.take(spark.createDataFrame(again.collect(), again.schema), stream, last)
    assert sink.read().count() == 6


def brute_gaps(rows, width):
    machines = {}
    for time, machine, location in rows:
        machines.setdefault((machine, location), set()).add(time // width)
    out = []
    for key, seen in machines.items():
        begun = None
        for b in range(min(seen), max(seen) + 1):
            if b not in seen and begun is None:
                begun = b
            elif b in seen and begun is not None:
                out.append((*key, begun * width, b * width, b - begun))
                begun = None
    return sorted(out)


@pytest.mark.parametrize("width", [60, 600, 3600, 86400])
def test_gaps(spark, width):
    import random

    rng = random.Random(width)
    day = 1_704_067_200
    rows = []
    for k in range(6):
        at_second = day - 3 * 86400 + rng.randint(0, 86400)
        for _ in range(25):
            rows.append((at_second, f"m{k % 3}", f"h{k}"))
            at_second += rng.choice([5, 60, 700, 4_000, 90_000, 260_000])
    rows += [(day, "edge", "h"), (day + 86400 - 60, "edge", "h"), (day + 2 * 86400, "edge", "h"), (day, "one", "h")]
    frame = spark.createDataFrame(rows, "s long, machine_id string, location string").withColumn("time", F.timestamp_seconds("s"))
    found = gap_report(frame.unionByName(frame.limit(3).withColumn("time", F.lit(None).cast("timestamp"))), timedelta(seconds=width))
    got = sorted((r[0], r[1], r[2], r[3], r[4]) for r in found.select("machine_id", "location", F.unix_seconds("gap_start"), F.unix_seconds("gap_end"), "missing").collect())
    assert got == brute_gaps(rows, width)
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_gaps_need_whole_days(spark, raw_rows):
    with pytest.raises(ValueError):
        gap_report(raw_rows(("10:00:00", "m1")), timedelta(minutes=7))
    assert gap_report(raw_rows(("10:00:00", "m1")).limit(0)).count() == 0


def test_nanoseconds_come_back(spark):
    micros = [1_700_000_000_000_016 + k for k in range(6_400)] + [-1, 0, 1, -(2**63) // 1000 + 1, (2**63 - 1) // 1000]
    frame = spark.createDataFrame([(m,) for m in micros], "m long").withColumn("time", F.timestamp_micros("m"))
    back = frame.select("m", F.unix_micros(from_unix_nanos(unix_nanos(F.col("time")))).alias("back"))
    assert back.filter("m <> back").count() == 0
    edges = spark.createDataFrame([(-(2**63),), (-(2**63) + 999,), (2**63 - 1,), (-1,)], "n long")
    found = [r[0] for r in edges.select(F.unix_micros(from_unix_nanos(F.col("n")))).collect()]
    assert found == [-(2**63) // 1000, (-(2**63) + 999) // 1000, (2**63 - 1) // 1000, -1]


def test_machine_predicate_is_pushed_and_files_hold_bloom_filters(spark, tables, raw_rows, monkeypatch):
    monkeypatch.setattr(tier_module, "BLOOM", tier_module.BLOOM | {"parquet.enable.dictionary": "false"})
    tables.write(RAW_TIER, raw_rows(*(("10:00:00", f"m{k}") for k in range(50))))
    rows = tables.read(RAW_TIER, "2024-01-01", machines=["m7"])
    assert rows.count() == 1
    pushed = rows._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1]
    assert "machine_id" in pushed.split("]")[0]
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(rows.inputFiles()[0])
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks()[0].getColumns()}
    reader.close()
    assert offsets["machine_id"] > 0 and offsets["power_kw"] < 0


def test_readers_see_the_old_or_the_new_dashboard(spark, tmp_path):
    def document(text):
        return spark.createDataFrame([(HEAD, text), (HEAD, text)], "part int, text string")

    board = PublishedDashboard(spark, str(tmp_path / "board"), keep=2)
    with pytest.raises(FileNotFoundError):
        board.read()
    board.publish(document("one"))
    old = board.read()
    board.publish(document("two"))
    assert [r[0] for r in old.collect()] == ["one"] * 2 and [r[0] for r in board.read().collect()] == ["two"] * 2
    # A writer that dies before the pointer leaves readers where they were.
    spark.createDataFrame([("half",)], "text string").write.text(f"{board.path}/versions/dead")
    assert [r[0] for r in board.read().collect()] == ["two"] * 2
    for n in range(3):
        board.publish(document(f"later {n}"))
    assert [r[0] for r in board.read().collect()] == ["later 2"] * 2
    assert len(board._fs_list(f"{board.path}/versions")) == len(board._fs_list(f"{board.path}/current")) == 2


def test_line_chart_reads_its_source_once(spark, raw_rows, tmp_path):
    from millrace.operators.reports import hourly_energy
    from millrace.operators.sections import line_chart_section

    raw_rows(*((f"{h:02}:01:10", f"m{h % 3}", "hall", float(h)) for h in range(9))).write.parquet(str(tmp_path / "raw"))
    hours = rollup_hour(rollup_minute(spark.read.parquet(str(tmp_path / "raw"))))
    series = line_chart_section(hourly_energy(hours, "2024-01-01 10:30:00", ordered=False))
    rows = series.orderBy("machine_id").collect()
    assert [r["labels"] for r in rows] == [[f"{h:02}:00" for h in range(9)]] * 3
    series.collect()
    plan = series._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("Scan parquet") <= 1
