from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.clock import (
    date_bin,
    floor_to,
    from_unix_nanos,
    from_unix_seconds,
    hour_label,
    instant,
    iso_string,
    to_utc,
    unix_nanos,
    utc_date,
    utc_hour,
)
from millrace.functions.numeric import half_up, parse_number, zero_fill
from millrace.functions.text import default_tag, escape_tag, topic_regex, unescape_tag
from millrace.operators.cleanse import event_time


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def text(spark, column):
    return value(spark, column.cast("string"))


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("12.5", 12.5), ("12.5kW", 12.5), (" 7", 7.0), ("1e3", 1000.0), ("1e", 1.0), ("-.5", -0.5), ("5.", 5.0),
        ("0x10", 0.0), ("1_000", 1.0), ("Infinity", float("inf")), ("-Infinity", float("-inf")),
        ("12.5d", 12.5), ("3f", 3.0), ("inf", None), ("nan", None), ("0x1p3", 0.0), ("0X1P3", 0.0), ("1e999", float("inf")),
        ("8 ", 8.0), ("+4", 4.0), ("1e-3V", 0.001), ("infinity", None),
        ("", None), ("abc", None), ("true", None), ("NaN", None), ('{"z":1}', None), ("[3,4]", None), (None, None),
    ],
)
def test_parse_number(spark, source, expected):
    assert value(spark, parse_number(F.lit(source).cast("string"))) == expected


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("1719652800000", "2024-06-29 09:20:00"),
        ("1.7e12", "2023-11-14 22:13:20"),  # an exponent, as the parser cannot tell numbers from texts
        ("2026-06-30T08:00:00.000Z", "2026-06-30 08:00:00"),
        ("2026-06-30T15:00:00+07:00", "2026-06-30 08:00:00"),
        ("2026-06-30", "2026-06-30 00:00:00"),
        *((x, "2000-01-01 00:00:00") for x in (
            "junk", "", "0", None, "9223372036854775807", "99999999999999999999", "12:30",
        )),
    ],
)
def test_event_time(spark, source, expected):
    assert text(spark, event_time(F.lit(source).cast("string"), instant("2000-01-01"))) == expected


@pytest.mark.parametrize(("x", "digits", "expected"), [(-2.5, 0, -2.0), (2.5, 0, 3.0), (1.005, 2, 1.0), (51.299, 2, 51.3)])
def test_half_up_rounds_towards_plus_infinity(spark, x, digits, expected):
    assert value(spark, half_up(F.lit(x), digits)) == expected


def test_zero_fill(spark):
    assert value(spark, zero_fill(F.lit(None).cast("double"))) == 0.0
    assert value(spark, zero_fill(F.lit(float("nan")))) == 0.0
    assert value(spark, zero_fill(F.lit(1.5))) == 1.5


def test_date_bin_floors_before_1970_and_honours_the_origin(spark):
    minute = timedelta(minutes=1)
    assert text(spark, date_bin(minute, instant("1969-12-31 23:59:30"))) == "1969-12-31 23:59:00"
    assert text(spark, date_bin(minute, instant("2024-01-01 00:01:00"))) == "2024-01-01 00:01:00"
    quarter = timedelta(minutes=15)
    assert text(spark, date_bin(quarter, instant("2024-01-01 00:04:59"), "1970-01-01 00:05:00")) == "2023-12-31 23:50:00"
    assert floor_to(minute, "1969-12-31 23:59:30") == to_utc("1969-12-31 23:59:00")


def test_partition_values_and_labels(spark):
    assert str(value(spark, utc_date(instant("1969-12-31 23:59:59.999999")))) == "1969-12-31"
    assert str(value(spark, utc_date(instant("2024-01-01 00:00:00")))) == "2024-01-01"
    assert value(spark, utc_hour(instant("2024-01-01 23:59:59.999999"))) == 23
    assert value(spark, hour_label(instant("2024-01-01 07:59:00"))) == "07:00"
    assert value(spark, iso_string(instant("2026-06-30 08:00:00"))) == "2026-06-30T08:00:00.000Z"


def test_epoch_units(spark):
    time = instant("2024-01-01 00:00:00.123456")
    assert value(spark, unix_nanos(time)) == 1704067200123456000
    assert text(spark, from_unix_nanos(unix_nanos(time))) == "2024-01-01 00:00:00.123456"
    assert text(spark, from_unix_nanos(F.lit(-1))) == "1969-12-31 23:59:59.999999"
    assert text(spark, from_unix_seconds(F.lit(1704067200))) == "2024-01-01 00:00:00"


def test_tags(spark):
    assert value(spark, escape_tag(F.lit("hall a,b=c"))) == r"hall\ a\,b\=c"
    assert value(spark, unescape_tag(F.lit(r"hall\ a\,b\=c"))) == "hall a,b=c"
    assert value(spark, default_tag(F.lit(None).cast("string"))) == "unknown"


def test_topic_regex():
    assert topic_regex("energy/+/data") == "^energy/[^/]*/data$"
