import re

import pytest
from pyspark.sql import functions as F

from lakeferry import FileSource
from lakeferry.functions.days import list_days
from tests.conftest import rows

DAYS = list_days("2018-04-19", "2018-04-21")


def put_shards(spark, root):
    for day in DAYS:
        number = int(day.strftime("%Y%m%d"))
        frame = spark.range(3).withColumn("red_price", F.lit(2.5))
        shard = frame if number > 20180420 else frame.drop("red_price")
        shard.write.parquet(f"{root}/order_log/yymmdd={number}")


def test_formats(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, v string")
    for file_format in ("parquet", "orc", "json"):
        frame.write.format(file_format).save(f"{tmp_path}/t.{file_format}")
        source = FileSource(spark, str(tmp_path), file_format, f".{file_format}")
        assert rows(source.read_table("t").select("id", "v")) == rows(frame)
        assert source.read_split("t", "id", 4).count() == 2


def test_delimited_text_with_null_tokens(spark, tmp_path):
    (tmp_path / "t").write_bytes(b"1\x01a\n2\x01\\N\n")
    options = {"sep": "\x01", "nullValue": "\\N", "schema": "id bigint, v string"}
    schema = options.pop("schema")
    source = FileSource(spark, str(tmp_path), "csv", "", options)
    read = source.read_table("t").toDF("id", "v").select(F.col("id").cast("bigint"), "v")
    assert read.schema == spark.createDataFrame([], schema).schema
    assert rows(read) == [(1, "a"), (2, None)]


def test_shards_by_name(spark, tmp_path):
    put_shards(spark, tmp_path)
    read = FileSource(spark, str(tmp_path)).read_shards("order_log", DAYS[1:])
    found = read.select("yymmdd", "red_price").distinct()
    assert rows(found) == [(20180420, None), (20180421, 2.5)]


def listed(spark, read):
    """The day folders that a scan has listed."""
    return {re.search(r"yymmdd=(\d+)", path).group(1) for path in read.inputFiles()}


def test_only_the_wanted_folders_are_listed(spark, tmp_path):
    put_shards(spark, tmp_path)
    (tmp_path / "order_log" / "yymmdd=20180401").mkdir()
    (tmp_path / "order_log" / "yymmdd=20180401" / "part-0.parquet").write_text("no parquet at all")
    source = FileSource(spark, str(tmp_path))
    for schema in (None, "id bigint, red_price double"):
        read = source.read_shards("order_log", [DAYS[0], DAYS[2]], schema=schema)
        assert listed(spark, read) == {"20180419", "20180421"}
        assert rows(read.select("yymmdd").distinct()) == [(20180419,), (20180421,)]
        assert read.schema["yymmdd"].dataType.simpleString() == "int"


def test_a_day_without_a_folder_is_an_error(spark, tmp_path):
    put_shards(spark, tmp_path)
    with pytest.raises(FileNotFoundError, match="yymmdd=20180422"):
        FileSource(spark, str(tmp_path)).read_shards("order_log", list_days("2018-04-21", "2018-04-22"))


def test_an_empty_folder_is_a_day_without_rows(spark, tmp_path):
    put_shards(spark, tmp_path)
    (tmp_path / "order_log" / "yymmdd=20180422").mkdir()
    source = FileSource(spark, str(tmp_path))
    read = source.read_shards("order_log", list_days("2018-04-21", "2018-04-22"))
    assert rows(read.select("yymmdd").distinct()) == [(20180421,)]
    alone = source.read_shards("order_log", list_days("2018-04-22", "2018-04-22"), schema="id bigint")
    assert alone.count() == 0


def test_logs_without_footers_need_a_schema(spark, tmp_path):
    spark.range(3).write.json(f"{tmp_path}/order_log/yymmdd=20180419")
    source = FileSource(spark, str(tmp_path), "json")
    with pytest.raises(ValueError, match="schema"):
        source.read_shards("order_log", DAYS[:1])
    assert source.read_shards("order_log", DAYS[:1], schema="id bigint").count() == 3


BROKEN = ['{"id": 1, "v": "a"}', '{"id": 2, "v": ', '{"id": 3, "v": "c"}', '{"id": "x", "v": "d"}']


def test_a_malformed_record_stops_the_read(spark, tmp_path):
    (tmp_path / "t.json").write_text("\n".join(BROKEN))
    (tmp_path / "t.csv").write_text("1,a\n2\n3,c\n")
    for file_format in ("json", "csv"):
        source = FileSource(spark, str(tmp_path), file_format, f".{file_format}", schema="id bigint, v string")
        with pytest.raises(Exception, match="(?i)malformed"):
            source.read_table("t").collect()
    # without a schema, a broken line is not taken for a column
    with pytest.raises(Exception, match="(?i)malformed"):
        FileSource(spark, str(tmp_path), "json", ".json").read_table("t").collect()
    chosen = FileSource(spark, str(tmp_path), "json", ".json", {"Mode": "DROPMALFORMED"}, "id bigint, v string")
    assert rows(chosen.read_table("t")) == [(1, "a"), (3, "c")]


def test_malformed_records_in_quarantine(spark, tmp_path):
    (tmp_path / "t.json").write_text("\n".join(BROKEN))
    (tmp_path / "t.csv").write_text("1,a\n2\n3,c\nx,d\n")
    for file_format in ("json", "csv"):
        aside = f"{tmp_path}/aside_{file_format}"
        source = FileSource(
            spark, str(tmp_path), file_format, f".{file_format}", None, "id bigint, v string", aside
        )
        for _ in range(2):
            assert rows(source.read_table("t")) == [(1, "a"), (3, "c")]
            assert source.read_table("t").columns == ["id", "v"]
            assert source.quarantined == {"t": 2}
        held = spark.read.json(f"{aside}/t")
        assert held.count() == 2 and {"file", "record", "read"} == set(held.columns)
        assert {r.record.strip() for r in held.collect()} & {BROKEN[1].strip(), "2"}
    inferred = FileSource(spark, str(tmp_path), "json", ".json", quarantine=f"{tmp_path}/other")
    assert rows(inferred.read_table("t").select("v")) == [("a",), ("c",), ("d",)]


def test_quarantine_of_a_log_is_by_day(spark, tmp_path):
    for day, lines in ((20180419, BROKEN), (20180420, BROKEN[:1]), (20180421, BROKEN[1:2])):
        folder = tmp_path / "order_log" / f"yymmdd={day}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(lines))
    source = FileSource(spark, str(tmp_path), "json", quarantine=f"{tmp_path}/aside")
    read = source.read_shards("order_log", DAYS, schema="id bigint, v string")
    assert rows(read) == [(1, "a", 20180419), (1, "a", 20180420), (3, "c", 20180419)]
    assert source.quarantined == {"order_log": 3}
    (tmp_path / "order_log" / "yymmdd=20180421" / "part.json").write_text(BROKEN[2])
    source.read_shards("order_log", DAYS[2:], schema="id bigint, v string")
    assert source.quarantined == {"order_log": 0}
    held = spark.read.json(f"{tmp_path}/aside/order_log")
    assert rows(held.groupBy("yymmdd").count()) == [(20180419, 2)]
