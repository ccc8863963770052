from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeferry.functions import cleaning


def cleaned(spark, values, **how):
    frame = spark.createDataFrame(list(enumerate(values)), "place int, value string")
    return [row.value for row in sorted(cleaning.clean(frame, **how).collect())]


def test_delimiters_and_null_token(spark):
    values = ["a\nb\r\x01c", "\\N", "\\N\r\n", "x\\N", "", None, "\n"]
    assert cleaned(spark, values) == ["abc", None, None, "x\\N", "", None, ""]


def test_zero_dates(spark):
    values = ["0000-00-00 00:00:00", "2018-04-20 01:02:03", None, "\\N\n"]
    got = cleaned(spark, values, datetimes=["VALUE"])
    assert got == [None, datetime(2018, 4, 20, 1, 2, 3), None, None]


def test_unreadable_times_fail_unless_asked_otherwise(spark):
    for value in ("2018-00-10", "soon", ""):
        with pytest.raises(Exception, match="not a time"):
            cleaned(spark, [value], datetimes=["value"])
        assert cleaned(spark, [value], datetimes=["value"], unreadable="null") == [None]
        assert cleaned(spark, [value]) == [value]
    with pytest.raises(ValueError):
        cleaning.zero_date(F.col("value"), unreadable="maybe")


def test_instants_are_shown_in_the_zone_asked_for(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            frame = spark.sql("SELECT timestamp_seconds(1704110400) AS t")
            got = cleaning.clean(frame, zone="Asia/Shanghai").selectExpr("CAST(t AS string)")
            assert got.first()[0] == "2024-01-01 20:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flags_become_integers(spark):
    frame = spark.sql("SELECT true AS a, CAST(NULL AS boolean) AS b, 3Y AS c, 4L AS d")
    got = cleaning.clean(frame)
    assert tuple(got.first()) == (1, None, 3, 4)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "int", "bigint"]


def test_source_zone_does_not_depend_on_the_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 20:00:00' AS ts")
    shown = frame.select(cleaning.in_source_zone(F.col("ts")).cast("string"))
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert shown.first()[0] == "2024-01-02 04:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_odd_column_names(spark):
    frame = spark.createDataFrame([("a\n", 1)], "`a.b` string, `c d` int")
    assert cleaning.clean(frame).first().asDict() == {"a.b": "a", "c d": 1}
