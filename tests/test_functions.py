"""Time, rounding, decimal and calendar semantics (FIXTURES C3-C5, C7)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from barlake.functions.time import (
    date_attributes,
    epoch_nanos_to_timestamp,
    local_to_utc,
    parse_time_lenient,
    round_to_second,
    to_price,
)


def test_nanos_use_integer_division(spark):
    df = spark.createDataFrame([(1774857600000000000,), (1774857600123456789,), (1774857600999999999,)], "t long")
    got = [r.ts for r in df.select(epoch_nanos_to_timestamp("t", LongType()).alias("ts")).collect()]
    assert got == [dt.datetime(2026, 3, 30, 8, 0), dt.datetime(2026, 3, 30, 8, 0, 0, 123456),
                   dt.datetime(2026, 3, 30, 8, 0, 0, 999999)]


def test_local_to_utc_independent_of_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 30, 8, 0),), (dt.datetime(2026, 3, 30, 0, 30),)], "ts timestamp_ntz")
    results = []
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Ho_Chi_Minh", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append([tuple(r) for r in df.select(local_to_utc("ts", "Asia/Ho_Chi_Minh").alias("u"),
                                                          F.to_date("ts").alias("d")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1] == results[2]
    assert results[0] == [(dt.datetime(2026, 3, 30, 1, 0), dt.date(2026, 3, 30)),
                          (dt.datetime(2026, 3, 29, 17, 30), dt.date(2026, 3, 30))]


def test_second_rounding_half_up(spark):
    base = dt.datetime(2026, 1, 1, 0, 0, 0)
    vals = [base.replace(microsecond=m) for m in (400000, 500000, 600000)]
    df = spark.createDataFrame([(v,) for v in vals], "ts timestamp_ntz")
    got = [r.r for r in df.select(round_to_second("ts").alias("r")).collect()]
    assert got == [base, base.replace(second=1), base.replace(second=1)]


def test_price_decimal_half_up(spark):
    df = spark.createDataFrame([(0.00005,), (0.00015,), (-0.00005,), (2.12345,)], "x double")
    got = [r.p for r in df.select(to_price("x").alias("p")).collect()]
    assert got == [Decimal("0.0001"), Decimal("0.0002"), Decimal("-0.0001"), Decimal("2.1235")]


def test_day_of_week_and_weekend(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2026, 1, 3),), (dt.date(2026, 1, 4),)], "d date")
    got = [tuple(r) for r in df.select(*date_attributes("d")).collect()]
    assert got[0] == (20260101, dt.date(2026, 1, 1), 2026, 1, 1, 1, 5, False)
    assert got[1][6:] == (7, True) and got[2][6:] == (1, True)


def test_parse_lenient_drops_nothing_silently(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("bad",), (None,)], "s string")
    got = [r.t for r in df.select(parse_time_lenient("s").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]
