import re
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeferry import (
    COMPAT,
    LOG_TABLES,
    SNAPSHOT_TABLES,
    FileSource,
    FrameSource,
    Reading,
    load_day,
    load_days,
    load_snapshot,
    load_snapshots,
    strict,
)
from lakeferry.functions.days import back, list_days
from lakeferry.operators.warehouse import list_partitions
from lakeferry.plans.loads import SNAPSHOT_WRITES, stage_days
from tests.conftest import rows

LOG = LOG_TABLES["order_log"]
USERS = SNAPSHOT_TABLES["user_auth"]


def users(spark, names=("John Smithson", "Anna", "王小明")):
    made = [
        (i, f"6222{i}", name, f"1380000800{i}", 1, "2018-04-20 00:00:00")
        for i, name in enumerate(names)
    ]
    return spark.createDataFrame(
        made,
        "uid bigint, person_card string, realname string, mobile string,"
        " status int, lasttime string",
    )


def log(spark, start="2018-04-19", end="2018-04-21"):
    days = spark.createDataFrame([(str(day),) for day in list_days(start, end)], "day string")
    time = F.col("day").cast("timestamp_ntz")
    named = {"createtime": time, "red_price": F.lit(2.5), "date": F.col("day")}
    named |= {"finishtime": F.col("day"), "shelltime": F.lit("0000-00-00 00:00:00")}
    return days.select(
        *[
            named.get(c, F.concat(F.lit(f"{c} "), F.col("day"))).alias(c)
            for c in LOG.columns
        ]
    )


def log_source(frame):
    return FrameSource(logs={"order_log": (frame, "createtime")})


class FailingSource(FrameSource):
    def read_split(self, name, key, readers=1, **more):
        return self.tables[name].withColumn("realname", F.raise_error(F.lit("lost")))

    def read_shards(self, *asked):
        return super().read_shards(*asked).withColumn("ua", F.raise_error(F.lit("lost")))


@pytest.mark.parametrize("name", SNAPSHOT_TABLES)
def test_specs_are_consistent(name):
    spec = SNAPSHOT_TABLES[name]
    assert len(set(spec.columns)) == len(spec.columns)
    assert set(spec.masks) | set(spec.strict_masks) <= set(spec.columns)


def test_mask_counts():
    kinds = [kind for spec in SNAPSHOT_TABLES.values() for kind in spec.masks.values()]
    assert len(SNAPSHOT_TABLES) == 16
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "name": 8, "phone": 7, "short_phone": 1, "hash": 8,
    }
    assert len(LOG.columns) == 54 and LOG.columns[5] == "red_price"


def test_daily_runs_publish_one_day_and_keep_one_staged(spark, warehouse):
    for today, names in (("2018-04-20", ("Old",)), ("2018-04-21", ("Anna", "Bo"))):
        load_snapshot(FrameSource({"user_auth": users(spark, names)}), warehouse, USERS, today)
    assert spark.table(warehouse.raw("user_auth")).count() == 2
    masked = spark.table(warehouse.masked("user_auth"))
    assert rows(masked.select("realname")) == [("A**a",), ("B*",)]
    assert list_partitions(spark, warehouse.staging("user_auth")) == [20180420]


def test_several_tables_at_once(spark, warehouse):
    """Settings of the session are as they were; one failure costs the other tables nothing."""
    names = ["user_auth", "one", "two", "three"]
    specs = [replace(USERS, name=name) for name in names]
    source = FrameSource({name: users(spark) for name in names})
    keys = [*SNAPSHOT_WRITES]
    before = [spark.conf.get(key, None) for key in keys]
    load_snapshots(source, warehouse, specs, "2018-04-20", at_once=3)
    assert [spark.conf.get(key, None) for key in keys] == before
    assert all(spark.table(warehouse.masked(name)).count() == 3 for name in names)
    source.tables["one"] = users(spark).withColumn("realname", F.raise_error(F.lit("lost")))
    source.tables["two"] = users(spark, ("Bo",))
    with pytest.raises(Exception, match="lost"):
        load_snapshots(source, warehouse, specs, "2018-04-21", at_once=2)
    counts = [spark.table(warehouse.masked(name)).count() for name in names]
    assert counts == [3, 3, 1, 3]


def test_a_skipped_run_is_not_published_again(spark, warehouse):
    source = FrameSource({"user_auth": users(spark)})
    load_snapshot(source, warehouse, USERS, "2018-04-20")
    load_snapshot(source, warehouse, USERS, "2018-04-23")
    # nor does the raw staging of the skipped run stay for good
    assert list_partitions(spark, warehouse.staging("user_auth")) == [20180422]
    assert spark.table(warehouse.masked("user_auth")).count() == 3


def test_failed_read_stops_before_publishing_and_dropping(spark, warehouse):
    load_snapshot(FrameSource({"user_auth": users(spark)}), warehouse, USERS, "2018-04-20")
    before = rows(spark.table(warehouse.masked("user_auth")))
    with pytest.raises(Exception, match="lost"):
        load_snapshot(FailingSource({"user_auth": users(spark)}), warehouse, USERS, "2018-04-21")
    assert rows(spark.table(warehouse.masked("user_auth"))) == before
    assert list_partitions(spark, warehouse.staging("user_auth")) == [20180419]


def test_layers_have_the_same_shape_and_rows(spark, warehouse):
    load_snapshot(FrameSource({"user_auth": users(spark)}), warehouse, USERS, "2018-04-20")
    masked = spark.table(warehouse.masked("user_auth"))
    raw = spark.table(warehouse.raw("user_auth"))
    assert masked.schema == raw.schema and tuple(masked.columns) == USERS.columns
    assert rows(masked.select("uid", "status")) == rows(raw.select("uid", "status"))
    for column in USERS.masks:
        assert not set(rows(masked.select(column))) & set(rows(raw.select(column)))


def test_spelling_of_source_columns_does_not_matter(spark, warehouse):
    for today, spell in (("2018-04-20", str.upper), ("2018-04-21", str.lower)):
        spelled = users(spark).toDF(*map(spell, USERS.columns))
        load_snapshot(FrameSource({"user_auth": spelled}), warehouse, USERS, today)
        masked = spark.table(warehouse.masked("user_auth"))
        assert tuple(masked.columns) == USERS.columns
        assert rows(masked.select("realname")) == [("A**a",), ("J" + "*" * 13 + "n",), ("王*明",)]


def test_times_kept_as_text_are_read(spark, warehouse):
    frame = users(spark).withColumn("lasttime", F.expr(
        "if(uid = 0, '0000-00-00 00:00:00', lasttime)"
    ))
    load_snapshot(FrameSource({"user_auth": frame}), warehouse, USERS, "2018-04-20")
    published = spark.table(warehouse.raw("user_auth"))
    assert published.schema["lasttime"].dataType.simpleString() == "timestamp_ntz"
    assert rows(published.select("lasttime").distinct()) == [(None,), (datetime(2018, 4, 20),)]


def test_times_can_be_left_as_text(spark, warehouse):
    frame = users(spark).withColumn("lasttime", F.lit("1524182400"))
    source = FrameSource({"user_auth": frame, "other": frame})
    with pytest.raises(Exception, match="not a time"):
        load_snapshot(source, warehouse, replace(USERS, name="other"), "2018-04-20")
    load_snapshot(source, warehouse, USERS, "2018-04-20", reading=Reading(times=False))
    assert spark.table(warehouse.raw("user_auth")).first().lasttime == "1524182400"


def test_strict_needs_a_salt():
    for salt in ("", None):
        with pytest.raises(ValueError, match="salt"):
            strict(salt)


def test_openid_is_masked_in_every_table_in_strict():
    specs = [*SNAPSHOT_TABLES.values(), LOG]
    assert all(
        {c for c in spec.columns if c.endswith("openid") and c != "subscribe_openid"}
        <= set(spec.masks_for(strict("salt")))
        for spec in specs
        if "openid" in spec.columns
    )


def test_specs_are_those_of_the_fixtures():
    """The column lists, as written down apart from the code."""
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    for spec in [*SNAPSHOT_TABLES.values(), LOG]:
        assert re.search(r"\b" + r"[\s,`|]+".join(spec.columns) + r"\b", text), spec.name


def test_a_day_that_was_not_delivered_costs_nothing(spark, warehouse, tmp_path):
    """Published and staged days stay, if a folder is missing; an empty folder empties its day."""
    days = list_days("2018-04-21", "2018-04-23")
    for day in days:
        shard = log(spark, str(day), str(day))
        shard.write.parquet(f"{tmp_path}/order_log/yymmdd={day:%Y%m%d}")
    load_days(FileSource(spark, str(tmp_path)), warehouse, LOG, days[0], days[-1])
    tables = [warehouse.masked("order_log"), warehouse.raw("order_log"), warehouse.staging("order_log")]
    before = [rows(spark.table(table)) for table in tables]
    other = FileSource(spark, str(tmp_path / "elsewhere"))
    for start, end in ((days[0], days[0]), (days[2], "2018-04-24")):
        with pytest.raises(FileNotFoundError):
            load_days(other, warehouse, LOG, start, end)
    assert [rows(spark.table(table)) for table in tables] == before
    (tmp_path / "empty" / "order_log" / "yymmdd=20180422").mkdir(parents=True)
    schema = spark.read.parquet(f"{tmp_path}/order_log/yymmdd=20180422").schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spec = replace(LOG, schema=ddl)
    load_day(FileSource(spark, str(tmp_path / "empty")), warehouse, spec, days[1])
    held = rows(spark.table(tables[0]).select("yymmdd"))
    assert held == rows(spark.table(tables[1]).select("yymmdd")) == [(20180421,), (20180423,)]


def test_a_failed_rerun_keeps_the_staged_day(spark, warehouse):
    source = log_source(log(spark))
    stage_days(source, warehouse, LOG, "2018-04-19", "2018-04-21")
    before = rows(spark.table(warehouse.staging("order_log")))
    with pytest.raises(Exception, match="lost"):
        stage_days(FailingSource(logs=source.logs), warehouse, LOG, "2018-04-20", "2018-04-20")
    assert rows(spark.table(warehouse.staging("order_log"))) == before


def test_a_rerun_without_rows_empties_the_day(spark, warehouse):
    stage_days(log_source(log(spark)), warehouse, LOG, "2018-04-19", "2018-04-21")
    stage_days(log_source(log(spark, "2018-04-19", "2018-04-20")), warehouse, LOG, "2018-04-20", "2018-04-21")
    assert list_partitions(spark, warehouse.staging("order_log")) == [20180419, 20180420]


def test_frames_give_exactly_the_days_asked_for(spark):
    source = log_source(log(spark))
    days = list_days("2018-04-19", "2018-04-21")
    read = source.read_shards("order_log", [days[2], days[0]])
    assert rows(read.select("yymmdd")) == [(20180419,), (20180421,)]


def test_rows_without_a_time_fail(spark):
    frame = log(spark).withColumn("createtime", F.expr("nullif(createtime, timestamp_ntz'2018-04-20')"))
    with pytest.raises(Exception, match="has no createtime"):
        log_source(frame).read_shards("order_log", list_days("2018-04-19", "2018-04-19")).collect()


def test_a_missing_column_stops_before_publishing(spark, warehouse):
    load_snapshot(FrameSource({"user_auth": users(spark)}), warehouse, USERS, "2018-04-20")
    lacking = users(spark).drop("mobile")
    wanted = replace(USERS, name="other")
    with pytest.raises(Exception, match="mobile"):
        load_snapshot(FrameSource({"other": lacking}), warehouse, wanted, "2018-04-21")
    assert not spark.catalog.tableExists(warehouse.masked("other"))


def test_a_column_that_the_source_has_lost_stops_the_load(spark, warehouse):
    load_snapshot(FrameSource({"user_auth": users(spark)}), warehouse, USERS, "2018-04-20")
    before = rows(spark.table(warehouse.masked("user_auth")))
    lacking = FrameSource({"user_auth": users(spark).drop("mobile")})
    with pytest.raises(ValueError, match="mobile"):
        load_snapshot(lacking, warehouse, USERS, "2018-04-21")
    assert rows(spark.table(warehouse.masked("user_auth"))) == before


def test_masked_number_column_is_text_in_both_layers(spark, warehouse):
    numbers = users(spark).withColumn("mobile", F.col("mobile").cast("bigint"))
    load_snapshot(FrameSource({"user_auth": numbers}), warehouse, USERS, "2018-04-20")
    assert ("138****8000",) in rows(spark.table(warehouse.masked("user_auth")).select("mobile"))
    assert ("13800008000",) in rows(spark.table(warehouse.raw("user_auth")).select("mobile"))


def test_staging_holds_all_columns_and_layers_the_listed_ones(spark, warehouse):
    wider = users(spark).withColumn("extra", F.lit("x"))
    load_snapshot(FrameSource({"user_auth": wider}), warehouse, USERS, "2018-04-20")
    assert "extra" in spark.table(warehouse.staging("user_auth")).columns
    assert "extra" not in spark.table(warehouse.raw("user_auth")).columns


@pytest.mark.parametrize("name", [name for name, spec in SNAPSHOT_TABLES.items() if spec.masks])
def test_strict_shows_no_sensitive_value(spark, warehouse, name):
    spec = SNAPSHOT_TABLES[name]
    secret = "13812345678"
    given = {spec.key: 1, **dict.fromkeys(spec.datetimes, "2018-04-20")}
    frame = spark.range(1).select(*[F.lit(given.get(c, secret)).alias(c) for c in spec.columns])
    profile = strict("pepper")
    load_snapshot(FrameSource({name: frame}), warehouse, spec, "2018-04-20", profile)
    masked = spark.table(warehouse.masked(name)).first()
    assert all(masked[column] != secret for column in spec.masks_for(profile))
    assert set(spec.masks) <= set(spec.masks_for(profile))


def test_eras(spark, warehouse):
    load_days(log_source(log(spark)), warehouse, LOG, "2018-04-19", "2018-04-21")
    for table in (warehouse.masked("order_log"), warehouse.raw("order_log")):
        published = spark.table(table)
        assert published.columns == [*LOG.columns, "yymmdd"]
        assert rows(published.select("yymmdd", "red_price", "date")) == [
            (20180419, None, "date"), (20180420, None, "date"), (20180421, 2.5, "date"),
        ]


def test_old_days_alone_then_newer_ones(spark, warehouse):
    """Staging begins without the later column and gains it."""
    old = log_source(log(spark, "2018-04-19", "2018-04-20").drop("red_price"))
    load_days(old, warehouse, LOG, "2018-04-19", "2018-04-20")
    load_day(log_source(log(spark)), warehouse, LOG, "2018-04-21")
    published = spark.table(warehouse.masked("order_log"))
    assert rows(published.select("yymmdd", "red_price")) == [
        (20180419, None), (20180420, None), (20180421, 2.5),
    ]


def test_backfill_equals_single_days(spark, warehouse):
    source = log_source(log(spark, "2018-05-01", "2018-05-05"))
    load_days(source, warehouse, LOG, "2018-05-01", "2018-05-05")
    other = replace(LOG, name="order_log_again")
    again = FrameSource(logs={"order_log_again": source.logs["order_log"]})
    for day in list_days("2018-05-01", "2018-05-05"):
        load_day(again, warehouse, other, day)
    for place in (warehouse.masked, warehouse.raw, warehouse.staging):
        one, two = spark.table(place("order_log")), spark.table(place("order_log_again"))
        assert rows(one) == rows(two)
    assert list_partitions(spark, warehouse.staging("order_log")) == [20180504, 20180505]
    assert spark.table(warehouse.masked("order_log")).count() == 5


def test_backfill_twice_changes_nothing(spark, warehouse):
    source = log_source(log(spark))
    load_days(source, warehouse, LOG, "2018-04-19", "2018-04-21")
    before = rows(spark.table(warehouse.masked("order_log")))
    load_days(source, warehouse, LOG, "2018-04-19", "2018-04-21")
    assert rows(spark.table(warehouse.masked("order_log"))) == before


def test_empty_range_does_nothing(spark, warehouse):
    load_days(log_source(log(spark)), warehouse, LOG, "2018-04-21", "2018-04-19")
    assert not spark.catalog.tableExists(warehouse.staging("order_log"))


def test_strict_log_shows_the_date_and_hides_the_rest(spark, warehouse):
    source = log_source(log(spark))
    load_days(source, warehouse, LOG, "2018-04-21", "2018-04-21", profile=strict("salt"))
    row = spark.table(warehouse.masked("order_log")).first()
    assert row.date == "2018-04-21"
    assert all(len(row[column]) == 64 for column in ("user_ip", "openid", "pay_openid"))


def test_staging_only(spark, warehouse):
    days = stage_days(log_source(log(spark)), warehouse, LOG, "2018-04-19", "2018-04-21")
    assert days[0] == back("2018-04-20", 1)
    assert list_partitions(spark, warehouse.staging("order_log")) == [20180419, 20180420, 20180421]
    assert not spark.catalog.tableExists(warehouse.masked("order_log"))
    assert COMPAT.name == "compat"
