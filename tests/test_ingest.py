from __future__ import annotations

import json
from datetime import timedelta

import pytest

from millrace.operators.cleanse import cleanse, reject_counts, rejected, rule_project, split_valid
from millrace.sources.messages import explode_batch, filter_topic, from_kafka, read_messages, to_messages
from tests.conftest import at, rows_of

GOOD = {
    "machine_id": "m1", "location": "hall", "timestamp": "2026-06-30T08:00:00.000Z", "power_kw": 12.45,
    "voltage_v": 220.3, "current_a": "56.6", "energy_kwh": 0.034, "power_factor": 0.95,
}


def messages(spark, *payloads, topic="energy/m1/data"):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    rows = [(topic, t, at("2000-01-01T00:00:00")) for t in texts]
    return spark.createDataFrame(rows, "topic string, payload string, received_at timestamp")


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def test_good_message(spark):
    valid, bad = split_valid(cleanse(messages(spark, GOOD)))
    row = valid.first()
    assert (row.machine_id, row.location, row.power_kw, row.current_a) == ("m1", "hall", 12.45, 56.6)
    assert rows_of(valid, "time") == [("2026-06-30 08:00:00",)]
    assert bad.isEmpty()


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        (without("machine_id"), "missing:machine_id"),
        (GOOD | {"location": None}, "missing:location"),
        (without("power_factor", "voltage_v"), "missing:voltage_v"),
        (without("power_factor") | {"power_kw": "abc"}, "missing:power_factor"),
        (GOOD | {"power_kw": "abc", "voltage_v": ""}, "nan:power_kw"),
        (GOOD | {"energy_kwh": "x", "current_a": True}, "nan:current_a"),
        (GOOD | {"power_factor": {"z": 1}}, "nan:power_factor"),
        (GOOD | {"power_kw": "Infinity"}, "non_finite:power_kw"),
        (GOOD | {"power_kw": "-Infinity", "voltage_v": "x"}, "nan:voltage_v"),
        ([GOOD], "missing:machine_id"),
        ("5", "missing:machine_id"),
        ("null", "bad_json"),
        ("", "bad_json"),
        (None, "bad_json"),
        ('{"machine_id":', "bad_json"),
        (json.dumps(GOOD) + " x", "bad_json"),
    ],
)
def test_reject_reason(spark, payload, reason):
    assert rows_of(rejected(cleanse(messages(spark, payload))), "reject_reason") == [(reason,)]


def test_lenient_values_pass(spark):
    odd = GOOD | {"location": "", "power_kw": "12.5kW", "voltage_v": " 7", "timestamp": 1719652800000, "extra": [1]}
    valid, bad = split_valid(cleanse(messages(spark, odd, without("timestamp"))))
    assert bad.isEmpty()
    assert rows_of(valid, "time", "location", "power_kw", "voltage_v") == [
        ("2000-01-01 00:00:00", "hall", 12.45, 220.3),
        ("2024-06-29 09:20:00", "", 12.5, 7.0),
    ]


def test_future_readings_can_be_kept_out(spark):
    assert rejected(cleanse(messages(spark, GOOD))).isEmpty()
    kept_out = rejected(cleanse(messages(spark, GOOD), timedelta(days=1)))
    assert rows_of(kept_out, "reject_reason") == [("future_time",)]


def test_reject_counts(spark):
    counts = reject_counts(cleanse(messages(spark, GOOD, "{", "{", without("location"))))
    assert rows_of(counts) == [("bad_json", 2), ("missing:location", 1)]


def test_filters_do_not_repeat_the_parse(spark):
    valid, _ = split_valid(cleanse(messages(spark, GOOD)))
    assert valid._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_topics(spark):
    topics = [(t,) for t in ("energy/m1/data", "energy//data", "energy/a/b/data", "energy/data", "xenergy/m1/data")]
    frame = spark.createDataFrame(topics, "topic string")
    assert rows_of(filter_topic(frame, "energy/+/data")) == [("energy//data",), ("energy/m1/data",)]
    two = spark.createDataFrame([("factory/h/m/energy",), ("factory/h/energy",), ("a.c/x",), ("abc/x",)], "topic string")
    assert rows_of(filter_topic(two, "factory/+/+/energy")) == [("factory/h/m/energy",)]
    assert rows_of(filter_topic(two, "a.c/+")) == [("a.c/x",)]


def test_explode_batch(spark):
    frame = explode_batch(messages(spark, [GOOD, GOOD | {"machine_id": "m2"}], GOOD, "[]", "junk"))
    checked = cleanse(frame)
    assert rows_of(split_valid(checked)[0], "machine_id") == [("m1",), ("m1",), ("m2",)]
    assert rows_of(rejected(checked), "payload") == [("junk",)]


def test_rule_project(spark):
    row = rule_project(messages(spark, GOOD | {"timestamp": 1719652800000})).first()
    assert (row.machine_id, row.ts_ms, row.mqtt_ts, row.power_kw) == ("m1", 1719652800000, 946684800000, 12.45)


def test_outgoing_messages_come_back(spark, raw_rows):
    raw = raw_rows(("10:00:00", "m1"), ("10:00:10", "m2", "yard", 3.5))
    out = to_messages(raw, raw["time"])
    assert rows_of(out, "topic") == [("energy/m1/data",), ("energy/m2/data",)]
    back = out.withColumn("payload", out.payload)
    assert rows_of(split_valid(cleanse(back))[0], "machine_id", "location", "power_kw") == [
        ("m1", "hall", 1.0), ("m2", "yard", 3.5),
    ]


def test_landed_messages(spark, tmp_path):
    path = str(tmp_path / "landing")
    messages(spark, GOOD).write.json(path)
    assert rows_of(split_valid(cleanse(read_messages(spark, path)))[0], "machine_id") == [("m1",)]


def test_kafka_records(spark):
    records = spark.createDataFrame(
        [(bytearray(b"energy/m1/data"), bytearray(json.dumps(GOOD).encode()), at("2000-01-01T00:00:00"))],
        "key binary, value binary, timestamp timestamp",
    )
    assert rows_of(split_valid(cleanse(from_kafka(records)))[0], "machine_id", "received_at") == [
        ("m1", "2000-01-01 00:00:00")
    ]
