from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stockloom.functions import calendar
from stockloom.operators.star import parse_timestamps


def stamps(spark, *texts):
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string")
    return df.withColumn("ts", F.col("text").cast("timestamp_ntz"))


def values(df, column):
    return [row[0] for row in df.orderBy("i").select(column).collect()]


def test_week_runs_from_tuesday_to_monday(spark):
    df = stamps(
        spark,
        "2018-01-01 00:00:00",
        "2018-01-01 10:00:00",
        "2018-01-01 23:59:59",
        "2018-01-02 00:00:00",
        "2018-01-07 12:00:00",
        "2018-01-08 09:00:00",
    )
    first, second = datetime(2018, 1, 1), datetime(2018, 1, 8)
    found = values(df, calendar.week_ending_monday(F.col("ts")))
    assert found == [first] * 3 + [second] * 3


def test_weeks_to_event(spark):
    df = stamps(spark, "2018-11-24", "2018-11-19", "2018-11-26", "2018-01-01", "2018-11-12")
    assert values(df, calendar.weeks_to_event(F.col("ts"))) == [0, 0, 20, 20, 1]
    assert values(df, calendar.weeks_to_event(F.col("ts"), cap=99))[2] == 51


def test_event_day_after_midnight_counts_to_next_year(spark):
    df = stamps(spark, "2018-11-24 00:00:01", "2018-11-23 12:00:00")
    assert values(df, calendar.weeks_to_event(F.col("ts"), cap=99)) == [52, 0]


def test_iso_week_belongs_to_next_year_while_year_does_not(spark):
    df = stamps(spark, "2018-12-31")
    assert values(df, calendar.iso_week(F.col("ts"))) == [1]
    assert values(df, F.year("ts")) == [2018]


def test_days_are_rounded_down(spark):
    df = stamps(spark, "2018-01-10 12:00:00", "2018-01-11 23:59:59", "2018-01-12 00:00:00", None)
    start = F.lit("2018-01-11 00:00:00").cast("timestamp_ntz")
    assert values(df, calendar.whole_days(start, F.col("ts"))) == [-1, 0, 1, None]
    half_second_early = F.lit("2018-01-10 23:59:59.5").cast("timestamp_ntz")
    assert values(df, calendar.whole_days(start, half_second_early))[0] == -1


def test_only_the_expected_layout_parses(spark):
    texts = ["2018-01-02 03:04:05", "2018-01-02", "bad", "2018-02-30 00:00:00", None]
    df = stamps(spark, *[None] * len(texts)).drop("text", "ts")
    df = df.join(
        spark.createDataFrame(list(enumerate(texts)), "i int, order_approved_at string"), "i"
    )
    parsed = parse_timestamps(df)
    assert values(parsed, "order_approved_at") == [datetime(2018, 1, 2, 3, 4, 5)] + [None] * 4
    assert dict(parsed.dtypes)["order_approved_at"] == "timestamp_ntz"


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
def test_results_do_not_depend_on_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = stamps(spark, "2017-10-15 00:30:00", "2018-01-01 23:59:59")
        weeks = values(df, calendar.week_ending_monday(F.col("ts")))
        assert weeks == [datetime(2017, 10, 16), datetime(2018, 1, 1)]
        assert values(df, calendar.weekday_name(F.col("ts"))) == ["Sunday", "Monday"]
        texts = values(df.withColumn("t", calendar.lenient_timestamp(F.col("text"))), "t")
        assert texts == [datetime(2017, 10, 15, 0, 30), datetime(2018, 1, 1, 23, 59, 59)]
        # The first clock time was skipped by the change to summer time in one of the zones.
        later = F.lit("2017-10-16 00:30:00").cast("timestamp_ntz")
        assert values(df, calendar.whole_days(F.col("ts"), later)) == [1, -78]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
