"""What the plans of the loads must look like to hold at scale."""

import re
from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from lakeferry import COMPAT, LOG_TABLES, SNAPSHOT_TABLES, FrameSource, TableSpec
from lakeferry.functions.days import as_day, day_key
from lakeferry.operators.warehouse import conform, create_shaped
from lakeferry.plans.loads import layers, load_days, stage_days, stage_snapshot
from lakeferry.session import FEW_DAYS, WIDE_TABLES, applied
from tests.conftest import plan_of
from workload import inputs
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def insert_plan(frame, table):
    view = f"rows_{uuid4().hex}"
    conform(frame, table).createOrReplaceTempView(view)
    asked = f"EXPLAIN FORMATTED INSERT OVERWRITE {table} SELECT * FROM {view}"
    return frame.sparkSession.sql(asked).first()[0]


def read_schema(plan):
    return re.search(r"ReadSchema: struct<(.*)>", plan).group(1)


def staged_snapshot(spark, warehouse, name):
    spec = SNAPSHOT_TABLES[name]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    wider = inputs.snapshot_input(documents, spec).withColumn("unlisted", F.lit("x"))
    stage_snapshot(FrameSource({name: wider}), warehouse, spec, "2024-01-02")
    return layers(warehouse.staged(name, [as_day("2024-01-02")]), spec, COMPAT)


def test_snapshot_publish_is_one_narrow_pruned_pass(spark, warehouse):
    for layer in staged_snapshot(spark, warehouse, "user_verify_data"):
        create_shaped(layer, warehouse.masked("user_verify_data"))
        plan = insert_plan(layer, warehouse.masked("user_verify_data"))
        assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan
        assert re.search(r"PartitionFilters: \[.*yymmdd.* = 20240102", plan)
        assert "unlisted" not in read_schema(plan)
        assert "* Project" in plan


def test_publishing_one_day_of_a_log_does_not_sort(spark, warehouse):
    events = spark.read.parquet(f"{SF}/events.parquet")
    source = FrameSource(logs={"events": (events, "ts")})
    spec = TableSpec("events", tuple(events.columns))
    days = stage_days(source, warehouse, spec, "2024-01-04", "2024-01-05")
    for wanted, sorts in ((days, True), (days[1:], False)):
        _, raw = layers(warehouse.staged("events", wanted), spec, COMPAT, keep=("yymmdd",))
        create_shaped(raw, warehouse.raw("events"), by_day=True)
        plan = insert_plan(raw, warehouse.raw("events"))
        assert ("Sort" in plan) is sorts
        assert "Exchange" not in plan and "PartitionFilters: [" in plan


def test_staging_aligned_days_does_not_sort(spark, warehouse):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("yymmdd", day_key(F.col("ts")))
    create_shaped(events, warehouse.staging("events"), by_day=True)
    assert "Sort" in insert_plan(events, warehouse.staging("events"))
    with applied(spark, FEW_DAYS):
        assert "Sort" not in insert_plan(events, warehouse.staging("events"))


def test_loading_many_days_of_a_log_does_not_sort(spark, warehouse, monkeypatch):
    seen = []

    def planned(frame, table, days, settings=WIDE_TABLES, compression=None):
        with applied(spark, settings):
            seen.append(insert_plan(frame, table))
        return []

    monkeypatch.setattr("lakeferry.operators.generations.new_days", planned)
    monkeypatch.setattr("lakeferry.operators.warehouse.Compared.check", lambda *given: None)
    events = spark.createDataFrame(
        [(n, datetime(2024, 1, 4 + n % 2), "x") for n in range(6)], "id long, ts timestamp_ntz, v string"
    )
    spec = TableSpec("events", ("id", "ts", "v"))
    source = FrameSource(logs={"events": (events, "ts")})
    load_days(source, warehouse, spec, "2024-01-04", "2024-01-05", None)
    assert len(seen) == 3
    assert not any("Sort" in plan for plan in seen)


def test_staging_a_snapshot_does_not_sort(spark, warehouse):
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn("yymmdd", F.lit(20240102))
    create_shaped(documents, warehouse.staging("documents"), by_day=True)
    plan = insert_plan(documents, warehouse.staging("documents"))
    assert "Sort" not in plan and "Exchange" not in plan


def test_log_days_reach_the_scan_and_shuffle_once(spark, warehouse):
    events = spark.read.parquet(f"{SF}/events.parquet")
    rows = inputs.log_input(events, LOG_TABLES["order_log"])
    source = FrameSource(logs={"order_log": (rows, "createtime")})
    read = source.read_shards("order_log", [as_day("2024-01-05")])
    plan = plan_of(read)
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-06" in plan
    spanned = [as_day("2024-01-05"), as_day("2024-01-06")]
    rebalanced = source.read_shards("order_log", spanned).hint("rebalance", "yymmdd")
    assert plan_of(rebalanced).count("Exchange (") == 1


@pytest.mark.parametrize("day_aligned", [True, False])
def test_only_frames_in_no_order_are_rebalanced(spark, warehouse, monkeypatch, day_aligned):
    events = spark.read.parquet(f"{SF}/events.parquet")
    spec = LOG_TABLES["order_log"]
    logs = {"order_log": (inputs.log_input(events, spec), "createtime")}
    seen = []
    monkeypatch.setattr(
        "lakeferry.operators.generations.new_days",
        lambda frame, *given: seen.append(plan_of(frame)) or [],
    )
    source = FrameSource(logs=logs, day_aligned=day_aligned)
    stage_days(source, warehouse, spec, "2024-01-05", "2024-01-06")
    assert ("Exchange" in seen[0]) is not day_aligned
    assert ("REBALANCE" in seen[0]) is not day_aligned


@pytest.mark.parametrize(
    "name",
    [
        "mask_name", "mask_phone", "mask_hash", "mask_strict", "scalar_functions", "clean_delims",
        "clean_null_token", "clean_zero_date", "clean_timezone", "schema_era", "calendar_range",
        "calendar_parse", "project_allow_list",
    ],
)
def test_column_queries_are_narrow(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Exchange" not in plan and "Python" not in plan


def test_columns_are_pruned(spark):
    plan = plan_of(QUERIES["project_allow_list"](spark, SF))
    assert read_schema(plan) == "c_custkey:bigint,c_name:string,c_mktsegment:string"
    assert read_schema(plan_of(QUERIES["calendar_offsets"](spark, SF))) == (
        "o_orderkey:bigint,o_orderdate:timestamp_ntz"
    )
