from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.json import json_scalar
from tidemark.functions.numeric import rounded_ratio, safe_ratio
from tidemark.functions.time import (
    as_instant, as_utc, cell_start, moment, parse_timestamp, truncate, whole_seconds,
)

MOMENTS = [
    datetime(2024, 3, 10, 2, 30, 11, 123456),  # does not exist on a New York clock
    datetime(2024, 11, 3, 1, 30),              # exists there twice
    datetime(1969, 12, 31, 23, 59, 59, 999999),
    datetime(1970, 1, 1),
    datetime(1900, 2, 28, 12, 0, 0, 1),
]


def micros(at):
    return (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_time_does_not_depend_on_the_session_zone(new_york):
    df = new_york.createDataFrame([(m,) for m in MOMENTS], "ts timestamp_ntz")
    ts = F.col("ts")
    rows = df.select(
        ts, as_utc(as_instant(ts)).alias("back"), F.unix_micros(as_instant(ts)).alias("us"),
        cell_start(ts, timedelta(minutes=30)).alias("cell"), truncate(ts, "hour").alias("hour"),
        truncate(ts, "second").alias("second"), truncate(ts, "month").alias("month"),
        whole_seconds(ts, ts + F.lit(timedelta(days=1, microseconds=999999))).alias("span"),
    ).collect()
    assert len(rows) == len(MOMENTS)
    half_hour = 30 * 60 * 1_000_000
    for row in rows:
        assert row.us == micros(row.ts) and row.back == row.ts
        assert micros(row.cell) == micros(row.ts) // half_hour * half_hour
        assert row.hour == row.ts.replace(minute=0, second=0, microsecond=0)
        assert row.second == row.ts.replace(microsecond=0)
        assert row.month == datetime(row.ts.year, row.ts.month, 1)
        assert row.span == 86400


def test_unknown_grain():
    with pytest.raises(ValueError):
        truncate(F.col("ts"), "fortnight")


def test_moment_is_taken_literally(new_york):
    at = MOMENTS[0]
    assert new_york.range(1).select(moment(at).alias("m")).first().m == at


def test_parse_timestamp_formats(new_york):
    texts = {
        "2024-03-10 02:30:11.123": (datetime(2024, 3, 10, 2, 30, 11, 123000), None),
        "2024-03-10 02:30:11": (None, datetime(2024, 3, 10, 2, 30, 11)),
        "2024-03-10T02:30:11.5+02:00": (None, datetime(2024, 3, 10, 0, 30, 11, 500000)),
        "2024-03-10T02:30:11Z": (None, datetime(2024, 3, 10, 2, 30, 11)),
        "2024-3-10 02:30:11.123": (None, None),
        "2024-13-10 02:30:11.123": (None, None),
        "2024-02-30 02:30:11.123": (None, None),
        "noise": (None, None),
    }
    df = new_york.createDataFrame([(t,) for t in [*texts, None]], "t string")
    every = parse_timestamp(F.col("t"), ("millis", "seconds", "iso"))
    rows = df.select("t", parse_timestamp(F.col("t")).alias("strict"), every.alias("any")).collect()
    for row in rows:
        strict, lenient = texts.get(row.t, (None, None))
        assert row.strict == strict
        assert row["any"] == (strict or lenient)


def test_json_scalar_takes_scalars_only(spark):
    cases = {
        '{"page":"a"}': "a", '{"page":"[a"}': "[a", '{"page":"{"}': "{", '{"page":7}': "7", '{"page":true}': "true",
        '{"page":null}': None, '{"page":[1]}': None, '{"page":{"x":1}}': None, '{"other":1}': None,
        '{"page":"a", bad': None, "noise": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "m string")
    for row in df.select("m", json_scalar(F.col("m"), "page").alias("v")).collect():
        assert row.v == cases.get(row.m)


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (1, 8), (0, 5), (None, 2)], "a bigint, b bigint")
    rows = df.select(
        rounded_ratio(F.col("a"), F.col("b"), 100).alias("pct"), safe_ratio(F.col("a"), F.col("b")).alias("r")
    ).collect()
    assert [r.pct for r in rows] == [Decimal("33.33"), None, Decimal("12.50"), Decimal("0.00"), None]
    assert [r.r for r in rows] == [1 / 3, None, 0.125, 0.0, None]


def test_rounding_is_half_up_on_the_exact_quotient(spark):
    df = spark.createDataFrame([(Decimal("10.01"), 2), (Decimal("0.03"), 4)], "a decimal(10,2), b bigint")
    rows = df.select(rounded_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in rows] == [Decimal("5.01"), Decimal("0.01")]
