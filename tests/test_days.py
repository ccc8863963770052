from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeferry.functions import days


def test_ranges(spark):
    pairs = [
        ("2018-02-27", "2018-03-02"),
        ("2018-01-01", "2018-01-01"),
        ("2018-01-02", "2018-01-01"),
    ]
    frame = spark.createDataFrame(pairs, "a string, b string")
    start, end = F.col("a").cast("date"), F.col("b").cast("date")
    spans = frame.select(days.day_range(start, end).alias("d"))
    assert [len(row.d) for row in spans.collect()] == [4, 1, 0]
    assert spans.select(F.explode("d")).count() == 5


def test_parse_and_format(spark):
    texts = ["2018-04-20", "2018/04/20", "20180420", "20 April", "", None]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    parsed = days.parse_day(F.col("t"))
    got = frame.select(parsed, days.day_key(parsed), days.format_day(parsed, "'")).collect()
    assert [tuple(row) for row in got[:3]] == [(date(2018, 4, 20), 20180420, "2018'04'20")] * 3
    assert [tuple(row) for row in got[3:]] == [(None, None, None)] * 3


def test_days_before_cross_months_and_leap_years(spark):
    frame = spark.sql("SELECT DATE'2020-03-01' AS d")
    assert frame.select(days.day_key(days.days_before(F.col("d"), 2))).first()[0] == 20200228


@pytest.mark.parametrize("text", ["2018-04-20", "2018/04/20", "20180420", date(2018, 4, 20)])
def test_python_days(text):
    assert days.partition_value(text) == 20180420
    assert days.back(text, 20) == date(2018, 3, 31)


def test_python_ranges():
    assert [d.day for d in days.list_days("20180227", "20180302")] == [27, 28, 1, 2]
    assert days.list_days("20180302", "20180301") == []
    with pytest.raises(ValueError):
        days.as_day("tomorrow")
