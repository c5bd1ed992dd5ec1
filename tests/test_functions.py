import hashlib
from datetime import date, datetime

import pytest
from helpers import explain
from pyspark.sql import functions as F

from viewlens import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("seconds", "category", "valid"),
    [
        (None, "long", None),
        (0, "short", False),
        (1, "short", True),
        (299, "short", True),
        (300, "medium", True),
        (1799, "medium", True),
        (1800, "long", True),
        (86400, "long", True),
        (86401, "long", False),
    ],
)
def test_category_and_validity(spark, seconds, category, valid):
    d = F.lit(seconds).cast("int")
    assert one(spark, fn.watch_category(d)) == category
    assert one(spark, fn.is_valid_view(d, F.lit("u"), F.lit("m"))) is valid
    missing = F.lit(None).cast("string")
    assert one(spark, fn.is_valid_view(d, missing, F.lit("m"))) is False
    assert one(spark, fn.is_valid_view(d, F.lit("u"), missing)) is False


@pytest.mark.parametrize(
    ("text", "time"),
    [
        ("2024-01-02T03:04:05.678901", datetime(2024, 1, 2, 3, 4, 5, 678901)),
        ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T05:04:05+02:00", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("not-a-timestamp", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time(spark, text, time):
    parsed = fn.event_time(F.lit(text).cast("string")).cast("timestamp_ntz")
    assert one(spark, parsed) == time


@pytest.mark.parametrize("parts", [("u", "m", "t"), (None, "m", "t"), (None, None, None)])
def test_event_hash_equals_text_formatting(spark, parts):
    expected = hashlib.md5("{}_{}_{}".format(*parts).encode()).hexdigest()
    assert one(spark, fn.event_hash(*[F.lit(p).cast("string") for p in parts])) == expected


def test_time_differences(spark):
    a, b = F.lit("2024-01-01 01:00:00.5").cast("timestamp"), F.lit("2024-01-01").cast("timestamp")
    assert one(spark, fn.seconds_between(a, b)) == 3600
    assert one(spark, fn.latency_seconds(a, b)) == 3600.5


def test_guarded_percentages(spark):
    assert one(spark, fn.percent_or_zero(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, fn.percent_or_zero(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, fn.percent_or_null(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, fn.percent_or_null(F.lit(1), F.lit(0))) is None


def test_flag_keeps_null(spark):
    assert one(spark, fn.to_flag(F.lit(True))) == 1
    assert one(spark, fn.to_flag(F.lit(None).cast("boolean"))) is None


@pytest.mark.parametrize(
    ("predicate", "first"),
    [
        (lambda c, t: fn.within(c, "1 hour", t), datetime(2024, 1, 10, 11, 30)),
        (lambda c, t: fn.within(c, "30 minutes", t), datetime(2024, 1, 10, 12, 0)),
        (fn.since_previous_midnight, datetime(2024, 1, 9)),
        (fn.same_day, datetime(2024, 1, 10)),
    ],
)
def test_time_filters_start_exactly(spark, predicate, first):
    now = "2024-01-10 12:30:00"
    start = F.lit(first.isoformat()).cast("timestamp")
    before = start - F.expr("INTERVAL 1 MICROSECOND")
    assert one(spark, predicate(start, now)) is True
    assert one(spark, predicate(before, now)) is False
    end = F.lit("2024-01-11" if predicate is fn.same_day else now).cast("timestamp")
    last = end if predicate is not fn.same_day else end - F.expr("INTERVAL 1 MICROSECOND")
    assert one(spark, predicate(last, now)) is True
    assert one(spark, predicate(last + F.expr("INTERVAL 1 MICROSECOND"), now)) is False


def test_same_day_ends_at_midnight(spark):
    midnight = F.lit("2024-01-11").cast("timestamp")
    assert one(spark, fn.same_day(midnight, datetime(2024, 1, 10, 23))) is False


def test_last_days(spark):
    assert one(spark, fn.last_days(F.lit(date(2024, 1, 3)), 7, "2024-01-10 09:00")) is True
    assert one(spark, fn.last_days(F.lit(date(2024, 1, 2)), 7, "2024-01-10 09:00")) is False
    assert one(spark, fn.last_days(F.lit(date(2024, 1, 10)), 7, "2024-01-10 09:00")) is True
    assert one(spark, fn.last_days(F.lit(date(2024, 1, 11)), 7, "2024-01-10 09:00")) is False


def test_as_of_defaults_to_now(spark):
    gap = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(fn.as_of_column())
    assert one(spark, gap) == 0


def test_time_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT timestamp'2024-01-01' AS ts, 1 AS a, 2 AS b").write.parquet(path)
    df = spark.read.parquet(path)
    plan = explain(df.where(fn.within("ts", "1 day", "2024-01-01 10:00")).select("a"))
    assert "GreaterThanOrEqual(ts,2023-12-31" in plan
    assert "ReadSchema: struct<ts:timestamp,a:int>" in plan
