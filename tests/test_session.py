import pytest
from pyspark.sql import functions as F

from lakeferry.operators import warehouse as tables
from lakeferry.session import WIDE_TABLES, applied


@pytest.mark.parametrize("before", [None, "1234"])
def test_settings_are_put_back(spark, before):
    key = "spark.sql.codegen.hugeMethodLimit"
    given = spark.conf.get(key, None)
    try:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        started_as = spark.conf.get(key)
        with pytest.raises(ZeroDivisionError), applied(spark, WIDE_TABLES):
            assert spark.conf.get(key) == "8000"
            raise ZeroDivisionError
        assert spark.conf.get(key) == started_as
    finally:
        spark.conf.set(key, given)


def test_writes_leave_the_session_as_it_was(spark, warehouse):
    key = "spark.sql.codegen.hugeMethodLimit"
    given = spark.conf.get(key)
    spark.conf.set(key, "65535")
    try:
        frame = spark.range(10).select("id", *[F.lit("x").alias(f"c{i}") for i in range(70)])
        tables.create_shaped(frame, warehouse.masked("wide"))
        tables.replace_whole(frame, warehouse.masked("wide"))
        assert spark.conf.get(key) == "65535"
        assert spark.table(warehouse.masked("wide")).count() == 10
    finally:
        spark.conf.set(key, given)
