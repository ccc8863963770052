"""The registered queries.

Each takes (spark, sf_dir) and gives a frame. Those that write tables do so in
databases of their own and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry import (
    COMPAT,
    LOG_TABLES,
    SNAPSHOT_TABLES,
    FileSource,
    FrameSource,
    TableSpec,
    load_day,
    load_days,
    load_snapshot,
    strict,
)
from lakeferry.functions import cleaning, days, masking
from lakeferry.operators import projection
from lakeferry.operators.warehouse import create_like, create_shaped, overwrite
from lakeferry.plans.loads import stage_days, stage_snapshot
from lakeferry.plans.profiles import Profile
from lakeferry.sources.jdbc import RANGE_ROWS
from lakeferry.sources.splits import Cutter
from workload import inputs
from workload.inputs import both_layers, new_warehouse, table

DOCUMENTS = TableSpec(
    "documents",
    ("doc_id", "text", "lang", "source"),
    masks={"text": "name", "lang": "hash", "source": "name"},
)
EVENTS = TableSpec("events", ("event_id", "ts", "event_type", "value", "props"))
CUSTOMER_COLUMNS = ("c_name", "c_mktsegment", "c_custkey")

# The days the load queries are run for. Events cover January 2024, so the
# changes of schema are set inside it, and for orders in the middle of theirs.
TODAY = "2024-01-03"
LAST_OLD_EVENT_DAY = 20240110
LAST_OLD_ORDER_DAY = 19980420
ONE_DAY = "2024-01-15"
SALT = "pepper"
STRICT_LOADS = ("agency", "area_agency", "cashier_relation", "shop_info", "shop_info_sub")


# -- sources


def src_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FileSource(spark, sf_dir).read_table("customer")


def _split(customer: DataFrame, key: str, readers: int) -> DataFrame:
    """How many readers ask for each row, and whether its reader has a fair share.

    The cuts and conditions are those of a split read, asked of the table as a
    database would be.
    """
    spark, view = customer.sparkSession, f"customer_{uuid4().hex}"
    customer.createOrReplaceTempView(view)
    cutter = Cutter(lambda query: spark.sql(query).collect(), key, readers, RANGE_ROWS, True)
    conditions = cutter.conditions([view])[view]
    holds = F.array(*[F.coalesce(F.expr(c), F.lit(False)) for c in conditions])
    rows = customer.select("c_custkey", "c_name", holds.alias("holds"))
    rows = rows.withColumn("reader", F.array_position("holds", True))
    total = F.sum("held").over(Window.partitionBy())
    shares = rows.groupBy("reader").agg(F.count("*").alias("held"))
    shares = shares.withColumn("fair", F.col("held") <= 2 * F.ceil(total / readers))
    return rows.join(shares, "reader").select(
        "c_custkey", "c_name", F.size(F.filter("holds", lambda x: x)).alias("readers"), "fair"
    )


def src_split_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by four readers, by a number."""
    return _split(table(spark, sf_dir, "customer"), "c_custkey", 4)


def src_split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by two readers, by a text."""
    return _split(table(spark, sf_dir, "customer"), "c_name", 2)


def src_day_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write events as day shards, the old ones without a column; read all back."""
    events = table(spark, sf_dir, "events")
    tagged = inputs.by_day(events.select(*EVENTS.columns))
    old = F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")
    root = inputs.scratch(spark)
    for shards in (tagged.where(old).drop("props"), tagged.where(~old)):
        writer = shards.hint("rebalance", "yymmdd").write.mode("append")
        writer.partitionBy("yymmdd").parquet(f"{root}/event_log")
    return FileSource(spark, root).read_shards("event_log", inputs.event_days(events))


# -- cleaning


def clean_delims(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("text"), F.lit("\r\x01"), F.col("lang"))
    frame = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return cleaning.clean(frame)


def clean_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    token = (
        F.when(key % 5 == 0, "\\N")
        .when(key % 7 == 0, "\\N\n")
        .when(key % 11 == 0, "\\N.")
        .otherwise(F.col("event_type"))
    )
    frame = table(spark, sf_dir, "events").select("event_id", token.alias("event_type"))
    return cleaning.clean(frame)


def clean_zero_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    text = (
        F.when(key % 6 == 0, "0000-00-00 00:00:00")
        .when(key % 11 != 0, F.col("ts").cast("string"))
    )
    frame = table(spark, sf_dir, "events").select("event_id", text.alias("ts"))
    return cleaning.clean(frame, datetimes=["ts"])


def clean_tinyint(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus") == "F")
    frame = table(spark, sf_dir, "orders").select("o_orderkey", flag.alias("finished"))
    return cleaning.clean(frame)


def clean_timezone(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = cleaning.in_source_zone(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", local.alias("ts"))


# -- projections and shapes


def project_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project(table(spark, sf_dir, "customer"), CUSTOMER_COLUMNS)


def project_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return projection.constant(customer, {"date": "date"})


def schema_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    name = warehouse.masked("customer")
    create_shaped(projection.project(table(spark, sf_dir, "customer"), CUSTOMER_COLUMNS), name)
    return spark.table(name)


def schema_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    customer = projection.project(table(spark, sf_dir, "customer"), CUSTOMER_COLUMNS)
    create_shaped(customer, warehouse.masked("customer"))
    create_like(spark, warehouse.raw("customer"), warehouse.masked("customer"))
    overwrite(customer, warehouse.raw("customer"))
    return spark.table(warehouse.raw("customer"))


def schema_era(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("red_price"),
        days.day_key(F.col("o_orderdate")).alias("yymmdd"),
    )
    return projection.era(orders, {"red_price": "double"}, LAST_OLD_ORDER_DAY)


# -- masks


def mask_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every document, as a name."""
    words = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", " ")).alias("place", "word")
    )
    return words.withColumn("masked", masking.mask_name("word"))


def _phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key, inputs.phone(key).alias("phone"))


def mask_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phones(spark, sf_dir).withColumn("masked", masking.mask_phone("phone"))


def mask_phone_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phones(spark, sf_dir).withColumn("masked", masking.mask_phone_short("phone"))


def mask_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    cards = table(spark, sf_dir, "customer").select(key, inputs.card(key).alias("card"))
    return cards.withColumn("masked", masking.hash_token("card"))


def mask_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masks of the strict profile, over the same words.

    A hash is ten times as long as its word and no codec shortens it, so in the
    order of the text the result is nearly all hashes. Each task puts equal words
    side by side, by a number that sorts fast: what writes or sends the rows then
    meets a hash once. Nothing is shuffled.
    """
    masks = strict(SALT).masks
    words = mask_name(spark, sf_dir).sortWithinPartitions(F.xxhash64("word"))
    return words.select(
        "doc_id",
        "place",
        masks["name"](F.col("word")).alias("name"),
        masks["short_phone"](F.col("word")).alias("phone"),
        masks["hash"](F.col("word")).alias("token"),
    )


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("c_name"), F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.length(name).alias("chars"),
        F.octet_length(name).alias("bytes"),
        F.length(F.encode(name, "UTF-8")).alias("encoded_bytes"),
        name.substr(2, 3).alias("piece"),
        F.replace(name, F.lit("0"), F.lit("*")).alias("replaced"),
        F.repeat(F.lit("*"), (key % 5).cast("int")).alias("stars"),
        F.sha2(name, 256).alias("digest"),
        (F.length(name) - 2).alias("inner_chars"),
        F.when(key <= 100, "low")
        .when(key >= 1000, "high")
        .when(key > 500, "upper")
        .when(key == 500, "middle")
        .otherwise("lower")
        .alias("band"),
    )


# -- staging, publishing, retention


def publish_snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage an older copy, then load the newer one: only that is published."""
    warehouse = new_warehouse(spark)
    documents = table(spark, sf_dir, "documents").select(*DOCUMENTS.columns)
    older = documents.withColumn("lang", F.lit("old"))
    spec = TableSpec("documents", DOCUMENTS.columns)
    stage_snapshot(FrameSource({"documents": older}), warehouse, spec, days.back(TODAY, 2))
    load_snapshot(FrameSource({"documents": documents}), warehouse, spec, TODAY)
    return spark.table(warehouse.masked("documents"))


def publish_two_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    documents = table(spark, sf_dir, "documents").select(*DOCUMENTS.columns)
    load_snapshot(FrameSource({"documents": documents}), warehouse, DOCUMENTS, TODAY)
    return both_layers(warehouse, "documents")


def _staged_events(spark: SparkSession, sf_dir: str):
    """Events staged under all of their days, and those days."""
    warehouse = new_warehouse(spark)
    events = table(spark, sf_dir, "events").select(*EVENTS.columns)
    source = FrameSource(logs={"events": (events, "ts")})
    span = inputs.event_days(events)
    stage_days(source, warehouse, EVENTS, span[0], span[-1])
    return warehouse, events, span


def stage_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage all days, then one of them again with other values."""
    warehouse, events, _ = _staged_events(spark, sf_dir)
    changed = events.withColumn("value", F.col("value") * 2)
    source = FrameSource(logs={"events": (changed, "ts")})
    for _ in range(2):
        stage_days(source, warehouse, EVENTS, ONE_DAY, ONE_DAY)
    return spark.table(warehouse.staging("events"))


def publish_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish one staged day out of many."""
    warehouse, _, _ = _staged_events(spark, sf_dir)
    wanted = [days.as_day(ONE_DAY)]
    staged = warehouse.staged("events", wanted)
    warehouse.publish_days(staged, staged, "events", wanted)
    return both_layers(warehouse, "events")


def retention_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop what retention drops after the last day: all but two days."""
    warehouse, _, span = _staged_events(spark, sf_dir)
    warehouse.expire("events", days.back(span[-1], 2))
    return spark.table(warehouse.staging("events"))


# -- calendar


def calendar_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days from an order's date to an end that may lie before it."""
    start = F.col("o_orderdate").cast("date")
    end = F.date_add(start, (F.col("o_orderkey") % 6 - 1).cast("int"))
    ranges = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(days.day_range(start, end)).alias("day")
    )
    day = F.col("day")
    return ranges.select(
        "o_orderkey",
        days.format_day(day).alias("plain"),
        days.format_day(day, "-").alias("dashed"),
        days.format_day(day, "/").alias("slashed"),
        days.format_day(day, ".").alias("dotted"),
    )


def calendar_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in three spellings, and some that are none, parsed again."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    spelled = (
        F.when(key % 4 == 0, days.format_day(day, "-"))
        .when(key % 4 == 1, days.format_day(day, "/"))
        .when(key % 4 == 2, days.format_day(day))
        .otherwise(F.concat(F.lit("day "), days.format_day(day)))
    )
    orders = table(spark, sf_dir, "orders").select(key, spelled.alias("spelled"))
    return orders.withColumn("yymmdd", days.day_key(days.parse_day(F.col("spelled"))))


def calendar_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions one and two days before each order date."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        days.day_key(day).alias("run_day"),
        days.day_key(days.days_before(day, 1)).alias("one_before"),
        days.day_key(days.days_before(day, 2)).alias("two_before"),
    )


# -- whole loads


def snapshot_load(
    spark: SparkSession, sf_dir: str, name: str, profile: Profile = COMPAT
) -> DataFrame:
    warehouse, spec = new_warehouse(spark), SNAPSHOT_TABLES[name]
    rows = inputs.snapshot_input(table(spark, sf_dir, "documents"), spec)
    load_snapshot(FrameSource({name: rows}), warehouse, spec, TODAY, profile)
    return both_layers(warehouse, name)


def _log_source(spark: SparkSession, sf_dir: str) -> tuple[FrameSource, DataFrame]:
    events = table(spark, sf_dir, "events")
    rows = inputs.log_input(events, LOG_TABLES["order_log"])
    return FrameSource(logs={"order_log": (rows, "createtime")}), events


def pipe_order_log_backfill(
    spark: SparkSession, sf_dir: str, profile: Profile = COMPAT
) -> DataFrame:
    """All days of the log, over the change of schema."""
    warehouse, spec = new_warehouse(spark), LOG_TABLES["order_log"]
    source, events = _log_source(spark, sf_dir)
    span = inputs.event_days(events)
    load_days(source, warehouse, spec, span[0], span[-1], LAST_OLD_EVENT_DAY, profile)
    return both_layers(warehouse, "order_log")


def pipe_order_log_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the log."""
    warehouse, spec = new_warehouse(spark), LOG_TABLES["order_log"]
    source, _ = _log_source(spark, sf_dir)
    load_day(source, warehouse, spec, ONE_DAY)
    return both_layers(warehouse, "order_log")


def pipe_numeric_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number that is masked is published as text, in both layers."""
    spec = TableSpec("documents", ("doc_id", "n_chars", "lang"), masks={"n_chars": "phone"})
    warehouse = new_warehouse(spark)
    documents = table(spark, sf_dir, "documents").select(*spec.columns)
    load_snapshot(FrameSource({"documents": documents}), warehouse, spec, TODAY)
    return both_layers(warehouse, "documents")


_BY_NAME = (
    src_snapshot,
    src_split_numeric,
    src_split_text,
    src_day_shards,
    clean_delims,
    clean_null_token,
    clean_zero_date,
    clean_tinyint,
    clean_timezone,
    project_allow_list,
    project_constant,
    schema_only,
    schema_like,
    schema_era,
    mask_name,
    mask_phone,
    mask_phone_short,
    mask_hash,
    mask_strict,
    scalar_functions,
    publish_snapshot_latest,
    publish_two_layers,
    stage_rerun,
    publish_day,
    retention_survivors,
    calendar_range,
    calendar_parse,
    calendar_offsets,
    pipe_order_log_backfill,
    pipe_order_log_daily,
    pipe_numeric_mask,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{query.__name__: query for query in _BY_NAME},
    **{f"pipe_{name}": partial(snapshot_load, name=name) for name in SNAPSHOT_TABLES},
    **{
        f"pipe_{name}_strict": partial(snapshot_load, name=name, profile=strict(SALT))
        for name in STRICT_LOADS
    },
    "pipe_order_log_strict": partial(pipe_order_log_backfill, profile=strict(SALT)),
}
