"""Inputs of the registered queries: the test tables, shaped like the real ones.

Every shaped frame is a narrow projection of a whole test table, so its size
follows that table. The test tables hold no NULLs and no phones; both are made
here by rules that the SQL side can state as well.
"""

from __future__ import annotations

import tempfile
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry import FileSource, TableSpec, Warehouse
from lakeferry.functions.days import day_key, list_days


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FileSource(spark, sf_dir).read_table(name)


def scratch(spark: SparkSession) -> str:
    """A fresh folder name where every executor can write.

    It lies in the folder the cluster names. Only a session on one machine may
    name none; it gets a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="lakeferry-")
    return f"{shared.rstrip('/')}/{uuid4().hex}"


def new_warehouse(spark: SparkSession) -> Warehouse:
    """Two fresh databases in a fresh folder."""
    tag = uuid4().hex[:12]
    return Warehouse(spark, f"masked_{tag}", f"raw_{tag}").create(scratch(spark))


def both_layers(warehouse: Warehouse, name: str) -> DataFrame:
    """What was published, with the name of the layer in each row."""
    spark = warehouse.spark
    masked = spark.table(warehouse.masked(name)).withColumn("layer", F.lit("masked"))
    raw = spark.table(warehouse.raw(name)).withColumn("layer", F.lit("raw"))
    return masked.unionByName(raw)


def phone(key: Column) -> Column:
    """Digits of every length from 1 to 11, and NULLs."""
    number = F.lit(13812345678) + (key * 7919) % 1000000000
    cut = F.pow(F.lit(10), 1 + key % 11).cast("long")
    return F.when(key % 13 != 0, (number % cut).cast("string"))


def card(key: Column) -> Column:
    """A card number, with empty texts and NULLs among them."""
    number = F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("6222"), key.cast("string")))
    return F.when(key % 11 != 0, number)


def person(text: Column, key: Column) -> Column:
    """The beginning of a text, 1 to 30 characters of it, and NULLs."""
    return F.when(key % 17 != 0, F.substr(text, F.lit(1), (1 + key % 30).cast("int")))


def time_text(key: Column) -> Column:
    """A time as text, with zero dates and null tokens among them."""
    day = F.lpad((1 + key % 28).cast("string"), 2, "0")
    spelled = F.concat(F.lit("2018-04-"), day, F.lit(" 01:02:03"))
    return F.when(key % 6 == 0, "0000-00-00 00:00:00").when(key % 7 == 0, "\\N\n").otherwise(spelled)


def labelled(column: str, key: Column) -> Column:
    return F.concat(F.lit(f"{column}_"), key.cast("string"))


def spoiled(column: str, key: Column) -> Column:
    """A label with a line feed in it, and null tokens."""
    return F.when(key % 9 == 0, "\\N").otherwise(F.concat(F.lit(f"{column}\n_"), key.cast("string")))


# What the first columns without a rule are filled with: whole columns of documents.
WHOLE = ("text", "lang", "source")


def whole_columns(spec: TableSpec) -> dict[str, str]:
    free = [c for c in spec.columns if c != spec.key and c not in spec.masks and c not in spec.datetimes]
    return dict(zip(free, WHOLE))


def snapshot_input(documents: DataFrame, spec: TableSpec) -> DataFrame:
    """Documents in the shape of a table: one row each, every column filled."""
    key = F.col("doc_id")
    whole = whole_columns(spec)
    rules = {
        "name": lambda: person(F.col("text"), key),
        "phone": lambda: phone(key),
        "short_phone": lambda: phone(key),
        "hash": lambda: card(key),
    }

    def value(column: str) -> Column:
        if column == spec.key:
            return key
        if column in spec.masks:
            return rules[spec.masks[column]]()
        if column in spec.datetimes:
            return time_text(key)
        if column in whole:
            return F.col(whole[column])
        return spoiled(column, key)

    return documents.select(*[value(column).alias(column) for column in spec.columns])


def log_input(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Events in the shape of the log, with ids, amounts and times of their own."""
    key = F.col("event_id")
    given = {
        spec.key: key,
        "uid": F.col("user_id"),
        "pay_price": F.col("value"),
        "red_price": F.col("value") / 2,
        "createtime": F.col("ts"),
        "finishtime": time_text(key),
        "shelltime": F.col("ts"),
        "attach": F.col("props"),
    }
    return events.select(
        *[given.get(column, labelled(column, key)).alias(column) for column in spec.columns]
    )


def event_days(events: DataFrame) -> list[date]:
    """The days that events cover, from one row of bounds."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    return list_days(first, last)


def by_day(events: DataFrame) -> DataFrame:
    return events.withColumn("yymmdd", day_key(F.col("ts")))
