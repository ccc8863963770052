"""Reads over JDBC, from a Derby database in the memory of the test's own JVM."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from lakeferry import LOG_TABLES, JdbcSource, TableSpec, load_days, load_snapshot
from lakeferry.functions.days import back, list_days
from lakeferry.plans.loads import stage_days
from lakeferry.sources import mysql_url
from tests.conftest import rows

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def url():
    return f"jdbc:derby:memory:db{uuid4().hex};create=true"


def put(frame, url, name):
    """Write a table with VARCHAR columns, since Derby cannot compare its CLOBs."""
    types = ", ".join(
        f"{field.name} VARCHAR(200)"
        for field in frame.schema
        if field.dataType.simpleString() == "string"
    )
    properties = {**DRIVER, "createTableColumnTypes": types} if types else DRIVER
    frame.coalesce(1).write.jdbc(url, name, "overwrite", properties)


@pytest.fixture(scope="module")
def customer(spark, url):
    frame = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    put(frame, url, "customer")
    return frame


def source(spark, url, **how):
    return JdbcSource(spark, url, DRIVER, **how)


def test_mysql_url():
    url = mysql_url("db.example:3306", "shop")
    assert url.startswith("jdbc:mysql://db.example:3306/shop?useUnicode=true&")
    for setting in (
        "characterEncoding=UTF-8",
        "zeroDateTimeBehavior=convertToNull",
        "tinyInt1isBit=false",
        "serverTimezone=Asia/Shanghai",
        "defaultFetchSize=10000",
        "useCursorFetch=true",
    ):
        assert setting in url


def test_fetch_size(spark, url):
    assert source(spark, url).properties["fetchsize"] == "10000"
    assert JdbcSource(spark, url, {"fetchsize": "5"}).properties["fetchsize"] == "5"


def test_whole_table(spark, url, customer):
    read = source(spark, url).read_table("customer")
    assert read.rdd.getNumPartitions() == 1
    assert rows(read) == rows(customer)


@pytest.mark.parametrize(("key", "readers"), [("c_custkey", 4), ("c_name", 2), ("c_acctbal", 5)])
def test_split_reads(spark, url, customer, key, readers):
    read = source(spark, url, readers=readers).read_split("customer", key)
    assert read.rdd.getNumPartitions() >= readers
    assert rows(read) == rows(customer)
    assert len(read.select(F.spark_partition_id()).distinct().collect()) > 1


def test_connections_are_bounded(spark, url, customer):
    read = source(spark, url, readers=6, connections=2).read_split("customer", "c_custkey")
    assert read.rdd.getNumPartitions() == 2
    assert rows(read) == rows(customer)


def sizes(frame):
    counted = frame.groupBy(F.spark_partition_id()).count().collect()
    return sorted(row["count"] for row in counted)


@pytest.mark.parametrize("type_name", ["bigint", "string"])
def test_ranges_are_balanced(spark, url, type_name):
    """Keys far from all others do not leave the rest to one reader."""
    crowd = spark.range(1, 1001).union(spark.range(10**12, 10**12 + 1))
    name = f"crowd_{type_name}"
    shown = F.lpad(F.col("id").cast("string"), 13, "0") if type_name == "string" else F.col("id")
    frame = crowd.select(shown.alias("k"))
    put(frame, url, name)
    read = source(spark, url, readers=5).read_split(name, "k")
    assert rows(read) == rows(frame)
    assert sizes(read)[-1] <= 2 * 201


def test_ranges_follow_the_rows(spark, url):
    frame = spark.range(1000).select(F.col("id").alias("k"))
    put(frame, url, "many")
    read = source(spark, url, readers=2, range_rows=50).read_split("many", "k")
    assert read.rdd.getNumPartitions() >= 10 and sizes(read)[-1] <= 100
    assert rows(read) == rows(frame)


def test_settings_of_the_url_can_be_changed():
    url = mysql_url("db.example:3306", "shop", zeroDateTimeBehavior="CONVERT_TO_NULL")
    assert "zeroDateTimeBehavior=CONVERT_TO_NULL" in url and "convertToNull" not in url


def test_a_missing_day_stops_the_load(spark, url, warehouse):
    days = shards(spark, url)
    with pytest.raises(Exception, match="ORDER_LOG_20180422|order_log_20180422"):
        source(spark, url).read_shards("order_log", [days[-1], back(days[-1], -1)], "id").collect()


def test_odd_text_keys(spark, url):
    values = ["it's", "", "é", "王", "z\\", "Z", "0"]
    frame = spark.createDataFrame([(value,) for value in values], "k string")
    put(frame, url, "odd")
    assert rows(source(spark, url, readers=4).read_split("odd", "k")) == rows(frame)


def test_null_keys(spark, url):
    frame = spark.createDataFrame([(None,), (None,), (1,), (50,), (99,)], "k int")
    put(frame, url, "gaps")
    assert rows(source(spark, url, readers=4).read_split("gaps", "k")) == rows(frame)


def test_empty_table(spark, url):
    put(spark.createDataFrame([], "k bigint, v string"), url, "nothing")
    assert source(spark, url).read_split("nothing", "k").count() == 0


def shards(spark, url):
    days = list_days("2018-04-19", "2018-04-21")
    for day in days:
        number = int(day.strftime("%Y%m%d"))
        frame = spark.range(10).select(
            F.concat(F.lit(f"{number}_"), F.col("id").cast("string")).alias("id"),
            F.lit(2.5).alias("red_price"),
        )
        put(frame if number > 20180420 else frame.drop("red_price"), url, f"order_log_{number}")
    return days


def test_day_shards_of_two_eras(spark, url):
    days = shards(spark, url)
    read = source(spark, url, readers=2).read_shards("order_log", days, "id")
    assert read.rdd.getNumPartitions() >= 6
    found = read.groupBy("yymmdd").agg(
        F.count("*"), F.countDistinct("id"), F.count("red_price")
    )
    assert rows(found) == [(20180419, 10, 10, 0), (20180420, 10, 10, 0), (20180421, 10, 10, 10)]


def test_log_load(spark, url, warehouse):
    spec = LOG_TABLES["order_log"]
    for day in list_days("2018-04-20", "2018-04-21"):
        number = int(day.strftime("%Y%m%d"))
        frame = spark.range(20).select(
            *[
                F.lit(None).cast("timestamp").alias(c)
                if c in spec.datetimes
                else F.concat(F.lit(f"{c}_"), F.col("id").cast("string")).alias(c)
                for c in spec.columns
            ]
        )
        put(frame.drop("red_price") if number <= 20180420 else frame, url, f"order_log_{number}")
    load_days(source(spark, url), warehouse, spec, "2018-04-20", "2018-04-21")
    published = spark.table(warehouse.masked("order_log"))
    assert rows(published.groupBy("yymmdd").agg(F.count("*"), F.count("red_price"))) == [
        (20180420, 20, 0), (20180421, 20, 20),
    ]


def test_snapshot_load(spark, url, customer, warehouse):
    spec = TableSpec("customer", ("c_custkey", "c_name"), masks={"c_name": "name"})
    load_snapshot(source(spark, url), warehouse, spec, "2018-04-21")
    assert rows(spark.table(warehouse.raw("customer"))) == rows(customer.select(*spec.columns))
    staged = spark.table(warehouse.staging("customer"))
    assert set(staged.columns) == {*customer.columns, "yymmdd"}


def execute(spark, url, *statements):
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        for statement in statements:
            connection.createStatement().execute(statement)
    finally:
        connection.close()


CHANGES = (
    'INSERT INTO "living" VALUES (5000, \'new\')',
    'UPDATE "living" SET "k" = "k" + 900 WHERE "k" < 50',
    'DELETE FROM "living" WHERE "k" BETWEEN 500 AND 520',
)


@pytest.mark.parametrize("hold", [True, False])
def test_a_table_that_is_written_between_cut_and_read(spark, url, hold):
    """Held, all readers see one state, and the writer gives up; else rows are missed or read twice."""
    frame = spark.range(900).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    put(frame, url, '"living"')
    wait = "CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY('derby.locks.waitTimeout', '{}')"
    execute(spark, url, wait.format(1))
    asked = source(spark, url, readers=4, hold=hold)
    written = False
    with asked.held(['"living"']):
        read = asked.read_split('"living"', "k")
        # the ranges are cut; the writer comes between them and the readers
        first = read.where(F.spark_partition_id() == 0).collect()
        try:
            execute(spark, url, *CHANGES)
            written = True
        except Exception as stopped:
            assert "lock" in str(stopped)
        rest = read.where(F.spark_partition_id() != 0).collect()
    assert written is not hold
    seen = sorted(r.k for r in first + rest)
    assert (seen == list(range(900))) is hold
    if hold:
        execute(spark, url, *CHANGES)
    execute(spark, url, wait.format(60))
    after = source(spark, url, readers=4).read_split('"living"', "k")
    assert after.count() == 900 + 1 - 21


def test_loads_hold_what_they_read(spark, url, customer, warehouse, monkeypatch):
    held = []
    monkeypatch.setattr(JdbcSource, "_locks", lambda self, names: held.append(list(names)) or [])
    spec = TableSpec("customer", ("c_custkey", "c_name"))
    load_snapshot(source(spark, url, hold=True), warehouse, spec, "2018-04-21")
    days = shards(spark, url)
    stage_days(source(spark, url, hold=True), warehouse, TableSpec("order_log", ("id",)), days[0], days[-1])
    assert held == [["customer"], [f"order_log_{day:%Y%m%d}" for day in days]]
    load_snapshot(source(spark, url), warehouse, spec, "2018-04-21")
    assert len(held) == 2


def test_locks_of_databases():
    here, there = JdbcSource(None, "jdbc:derby:x"), JdbcSource(None, "jdbc:mysql://x/y")
    assert here._locks(["a", "b"]) == ["LOCK TABLE a IN SHARE MODE", "LOCK TABLE b IN SHARE MODE"]
    assert there._locks(["a", "b"]) == ["LOCK TABLES a READ, b READ"]


def test_only_asked_columns_and_rows_are_read(spark, url, customer):
    read = source(spark, url).read_table("customer").where("c_custkey > 5").select("c_name")
    plan = read._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(c_custkey), *GreaterThan(c_custkey,5)]" in plan
    assert "ReadSchema: struct<c_name:string>" in plan
