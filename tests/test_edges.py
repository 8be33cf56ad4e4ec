"""Inputs that once gave wrong answers or lost rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.numeric import half_up
from millrace.operators.cleanse import cleanse
from millrace.plans.jobs import ingest_batch
from millrace.schemas import RAW_TIER
from tests.conftest import at

GOOD = {
    "machine_id": "m1", "location": "hall", "power_kw": 1.0, "energy_kwh": 0.1, "voltage_v": 220.0,
    "current_a": 5.0, "power_factor": 0.9, "timestamp": "2024-01-01T10:00:00Z",
}


def messages(spark, *payloads):
    rows = [("energy/m1/data", p, at("10:00:05")) for p in payloads]
    return spark.createDataFrame(rows, "topic string, payload string, received_at timestamp")


@pytest.mark.parametrize("value, digits", [(1.2e10, 9), (5e15, 9), (-5e15, 9), (1e300, 6)])
def test_half_up_keeps_large_values(spark, value, digits):
    row = spark.createDataFrame([(value,)], "v double").select(half_up(F.col("v"), digits)).first()
    assert row[0] == pytest.approx(value, rel=1e-15)


def test_half_up_keeps_nan(spark):
    row = spark.createDataFrame([(float("nan"),)], "v double").select(half_up(F.col("v"), 2)).first()
    assert row[0] != row[0]


def test_only_one_whole_object_is_json(spark):
    good = json.dumps(GOOD)
    bad = [good + "}", good + good, good + " {}", good + "," + good, good + "],[" + good, good.replace('"', "'"), good + " x", "", None]
    found = [r.reject_reason for r in cleanse(messages(spark, good, f" {good}\n", *bad)).select("reject_reason").collect()]
    assert found == [None, None] + ["bad_json"] * len(bad)


@pytest.mark.parametrize("stamp", [1719652800000, 1719652800000.0, 1719652800000.25, "1719652800000.25"])
def test_fractions_of_milliseconds(spark, stamp):
    rows = cleanse(messages(spark, json.dumps(GOOD | {"timestamp": stamp})))
    assert rows.select(F.unix_millis("time")).first()[0] == 1719652800000


def test_rejects_of_two_batches_stay(spark, tables, tmp_path):
    folder = str(tmp_path / "quarantine")
    ingest_batch(tables, messages(spark, "x", "y"), folder)
    ingest_batch(tables, messages(spark, "z"), folder)
    assert spark.read.parquet(folder).count() == 3
    ingest_batch(tables, messages(spark, "v"), folder, batch="named")
    ingest_batch(tables, messages(spark, "v"), folder, batch="named")
    assert spark.read.parquet(folder).count() == 4


def test_null_tags_are_keys(spark, tables, raw_rows):
    rows = raw_rows(("10:00:00", "m1", None)).unionByName(raw_rows(("10:00:00", "m1", "hall")))
    tables.upsert(RAW_TIER, rows)
    tables.upsert(RAW_TIER, rows)
    tables.upsert(RAW_TIER, raw_rows(("10:00:00", "m1", None, 7.0)))
    assert sorted(r.power_kw for r in tables.read(RAW_TIER).collect()) == [1.0, 7.0]


def test_copies_in_one_call_are_one_row(spark, tables, raw_rows):
    tables.upsert(RAW_TIER, raw_rows(("10:00:00", "m1"), ("10:00:00", "m1"), ("10:00:00", "m1", "hall", 2.0)))
    assert [r.power_kw for r in tables.read(RAW_TIER).collect()] == [2.0]
