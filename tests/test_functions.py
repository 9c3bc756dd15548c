from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedward import functions as fn


def evaluate(spark, column, **inputs):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("value", "places", "expected"),
    [
        (1.005, 2, 1.01),
        (0.285, 2, 0.29),
        (0.285 * 100, 0, 29.0),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (1e15 + 0.5, 0, 1e15 + 1),
        (None, 1, None),
    ],
)
def test_round_half_up(spark, value, places, expected):
    assert evaluate(spark, fn.round_half_up(F.lit(value).cast("double"), places)) == expected


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(1, 8, 12.5), (1, 3, 33.3), (1, 16, 6.3), (-1, 4, -25.0), (1, 0, None), (None, 4, None)],
)
def test_percent(spark, part, whole, expected):
    column = fn.percent(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint"), 1)
    assert evaluate(spark, column) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12.5", 12.5),
        (" 7 ", 7.0),
        ("12abc", 12.0),
        ("abc", 0.0),
        ("-3e2x", -300.0),
        (".5", 0.5),
        ("1e", 1.0),
        (None, None),
    ],
)
def test_number_prefix(spark, text, expected):
    assert evaluate(spark, fn.number_prefix(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("zone", ["UTC", "Australia/Sydney", "America/St_Johns"])
@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-04-13T09:51:58.077389", datetime(2026, 4, 13, 9, 51, 58)),
        ("2024-10-06 02:30:15.999999", datetime(2024, 10, 6, 2, 30, 15)),
        ("1969-12-31 23:59:59.5", datetime(1969, 12, 31, 23, 59, 59)),
        ("2021-11-15", datetime(2021, 11, 15)),
        ("not a time", None),
        (None, None),
    ],
)
def test_second_of_does_not_depend_on_the_zone(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        second = fn.second_of(F.lit(text).cast("string")).cast("string")
        assert evaluate(spark, second) == (None if expected is None else str(expected))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_of(spark):
    assert evaluate(spark, fn.day_of(F.lit("2024-02-29T23:59:59"))) == date(2024, 2, 29)
    assert evaluate(spark, fn.day_of(F.lit("2024-02-30"))) is None


def test_older_than_is_strict(spark):
    now = fn.stamp_literal(datetime(2024, 1, 2, 12))
    for text, expected in (
        ("2024-01-01 12:00:00", False),
        ("2024-01-01 11:59:59", True),
        (None, None),
    ):
        stamp = F.lit(text).cast("timestamp_ntz")
        assert evaluate(spark, fn.older_than(stamp, now, timedelta(days=1))) is expected


def test_breach_label_is_strict_and_ok_for_null(spark):
    ratio = fn.shortfall_ratio(F.col("e").cast("bigint"), F.col("r").cast("bigint"))
    label = fn.breach_label(ratio, 0.05)
    for expected, received, verdict in (
        (100, 95, "OK"),
        (100, 94, "BREACH"),
        (0, 0, "OK"),
        (100, 125, "OK"),
    ):
        assert evaluate(spark, label, e=expected, r=received) == verdict
