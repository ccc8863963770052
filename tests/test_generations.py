"""Tables and days that are switched to together: stops after each step, open readers, journals."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeferry import COMPAT, SNAPSHOT_TABLES, FrameSource, load_snapshot
from lakeferry.functions.days import as_day, list_days
from lakeferry.operators import generations
from lakeferry.operators.warehouse import LayersDiffer, conform, fits
from tests.conftest import plan_of, rows
from tests.test_warehouse import DAYS, log

USERS = SNAPSHOT_TABLES["user_auth"]


class Stopped(Exception):
    pass


class Steps:
    """Lets so many steps of a load pass: writes, catalog changes, small files."""

    def __init__(self, monkeypatch, spark, steps):
        self.left = steps
        for owner, name in (
            (type(spark), "sql"), (generations, "new_whole"), (generations, "new_days"),
            (generations, "write_text"), (generations, "delete"),
        ):
            monkeypatch.setattr(owner, name, self.counted(getattr(owner, name), name == "sql"))

    def counted(self, real, is_sql):
        def run(*given, **named):
            # reading the catalog changes nothing
            if not is_sql or str(given[1]).startswith("ALTER"):
                if not self.left:
                    raise Stopped
                self.left -= 1
            return real(*given, **named)

        return run


def layers(spark, warehouse, name):
    for table in (warehouse.masked(name), warehouse.raw(name)):
        spark.catalog.refreshTable(table)
    return [rows(spark.table(table)) for table in (warehouse.masked(name), warehouse.raw(name))]


def test_both_layers_are_of_one_load_wherever_it_stops(spark, warehouse, monkeypatch):
    old, new, last = (spark.range(n).withColumn("v", F.lit(str(n))) for n in (3, 5, 7))
    stops = 0
    for steps in range(40):
        name = f"t{steps}"
        warehouse.publish(old, old, name)
        with monkeypatch.context() as patch:
            Steps(patch, spark, steps)
            try:
                warehouse.publish(new, new, name)
                stopped = False
            except Stopped:
                stopped = True
        finished = warehouse.finish(name)
        masked, raw = layers(spark, warehouse, name)
        assert masked == raw and masked in (rows(old), rows(new))
        assert masked == rows(new) or (stopped and not finished)
        warehouse.publish(last, last, name)
        assert layers(spark, warehouse, name) == [rows(last)] * 2
        stops += stopped
        if not stopped:
            break
    assert 5 < stops < 39


def test_days_of_both_layers_are_of_one_load_wherever_it_stops(spark, warehouse, monkeypatch):
    # of four days, one is new, one is emptied, one is left alone
    old, new = log(spark, DAYS[:3]), log(spark, [DAYS[0], DAYS[3]], "new")
    days = [DAYS[0], DAYS[1], DAYS[3]]
    wanted = sorted([("v2", 20180420), ("new0", 20180418), ("new1", 20180421)])
    before = sorted([(f"v{n}", int(f"{day:%Y%m%d}")) for n, day in enumerate(DAYS[:3])])
    stops = 0
    for steps in range(40):
        name = f"d{steps}"
        warehouse.publish_days(old, old, name, DAYS[:3])
        with monkeypatch.context() as patch:
            Steps(patch, spark, steps)
            try:
                warehouse.publish_days(new, new, name, days)
                stopped = False
            except Stopped:
                stopped = True
        warehouse.finish(name)
        masked, raw = ([r[1:] for r in x] for x in layers(spark, warehouse, name))
        assert sorted(masked) == sorted(raw) and sorted(masked) in (before, wanted)
        stops += stopped
        if not stopped:
            assert sorted(masked) == wanted
            break
    assert 5 < stops < 39


def test_the_next_load_finishes_a_stopped_one(spark, warehouse, monkeypatch):
    """The next load of staging alone brings the layers to one day."""
    source = FrameSource({"user_auth": spark.createDataFrame([(1, "c", "Anna", "138", 1, "2018-04-20 00:00:00")],
        "uid bigint, person_card string, realname string, mobile string, status int, lasttime string")})
    load_snapshot(source, warehouse, USERS, "2018-04-20")
    with monkeypatch.context() as patch:
        real = generations._apply
        patch.setattr(generations, "_apply", lambda s, x: real(s, x[:1]) if len(x) > 1 else real(s, x))
        patch.setattr(generations, "delete", lambda *_: (_ for _ in ()).throw(Stopped()))
        staged = warehouse.staged("user_auth", [as_day("2018-04-19")]).drop("yymmdd")
        new = staged.withColumn("uid", F.lit(2).cast("long"))
        with pytest.raises(Stopped):
            warehouse.publish(new, new, "user_auth")
    assert layers(spark, warehouse, "user_auth")[0] != layers(spark, warehouse, "user_auth")[1]
    frame = warehouse.staged("user_auth", [as_day("2018-04-19")])
    warehouse.stage(frame, "user_auth", [as_day("2018-04-19")], aligned=True)
    masked, raw = layers(spark, warehouse, "user_auth")
    assert masked == raw and masked[0][0] == 2


def test_readers_of_a_day_are_not_cut_off_by_its_rerun(spark, warehouse):
    """A read that has begun ends with the old rows, one that begins has the new ones."""
    frame = log(spark)
    warehouse.stage(frame, "t", DAYS, aligned=False)
    warehouse.publish_days(frame, frame, "t", DAYS)
    names = [warehouse.staging("t"), warehouse.masked("t"), warehouse.raw("t")]
    opened = [spark.table(t) for t in names]
    begun = [spark.table(t).select("yymmdd", "value").repartition(1).toLocalIterator() for t in names]
    files = [one.inputFiles() for one in opened]
    first = [next(one) for one in begun]
    again = log(spark, DAYS[1:2], "new").unionByName(log(spark, DAYS[1:2], "newer"))
    warehouse.stage(again, "t", DAYS[1:2], aligned=True)
    warehouse.publish_days(again, again, "t", DAYS[1:2])
    assert [spark.read.orc(some).count() for some in files] == [4] * 3
    assert [sorted([a.value, *(r.value for r in one)]) for a, one in zip(first, begun)] == [["v0", "v1", "v2", "v3"]] * 3
    assert [one.count() for one in opened] == [spark.table(t).count() for t in names] == [5] * 3


def test_two_generations_of_a_day_are_kept_and_none_of_a_dropped_one(spark, warehouse):
    for value in ("a", "b", "c", "d"):
        warehouse.stage(log(spark, DAYS[:2], value), "t", DAYS[:2], aligned=True)
    root = Path(generations.root_of(spark, warehouse.staging("t")).removeprefix("file:"))
    held = lambda day: [p for p in root.parent.rglob(f"yymmdd={day}") if any(p.iterdir())]
    assert len(held(20180418)) == len(held(20180419)) == 2
    warehouse.expire("t", as_day("2018-04-18"))
    assert not held(20180418) and len(held(20180419)) == 2
    assert rows(spark.table(warehouse.staging("t")).select("value")) == [("d1",)]


def test_layers_that_differ_are_not_published(spark, warehouse):
    users = [(i, f"6222{i}", "Anna", "13800008000", 1, "2018-04-20 00:00:00") for i in range(4)]
    source = FrameSource({"user_auth": spark.createDataFrame(users,
        "uid bigint, person_card string, realname string, mobile string, status int, lasttime string")})
    load_snapshot(source, warehouse, USERS, "2018-04-20")
    before = layers(spark, warehouse, "user_auth")
    lossy = replace(COMPAT, masks={**COMPAT.masks, "name": lambda c: F.when(c != "Anna", c)})
    with pytest.raises(LayersDiffer, match="user_auth"):
        load_snapshot(source, warehouse, USERS, "2018-04-21", lossy)
    assert layers(spark, warehouse, "user_auth") == before
    for name, raw in (("few", "id < 9"), ("other", "id <> 9 OR v = 'x'")):
        frame = spark.range(10).withColumn("v", F.lit("y"))
        with pytest.raises(LayersDiffer):
            warehouse.publish(frame, frame.where(raw), name, ["id"])
        assert spark.table(warehouse.masked(name)).count() == 0
    swapped = spark.range(10).withColumn("v", F.lit("y"))
    with pytest.raises(LayersDiffer):
        warehouse.publish(swapped, swapped.withColumn("id", F.col("id") + 1), "swapped", ["id"])


def test_watching_takes_no_scan_of_its_own(spark, warehouse):
    from lakeferry.operators.warehouse import Compared

    frame = log(spark)
    warehouse.stage(frame, "t", DAYS, aligned=False)
    staged = warehouse.staged("t", DAYS)
    watched = Compared(["id"]).watch(conform(staged, warehouse.staging("t")))
    plan = plan_of(watched)
    assert plan.count("Scan orc") == plan_of(staged).count("Scan orc") and "Exchange" not in plan


def test_watching_interprets_no_expression_of_all_columns(spark, warehouse):
    from lakeferry.operators.warehouse import Compared

    frame = spark.createDataFrame([(1, None), (2, "a")], "id long, v string")
    watched = Compared(["id", "v"]).watch(frame)
    assert watched.columns == frame.columns and rows(watched) == rows(frame)
    observed = [line for line in plan_of(watched).splitlines() if " AS rows#" in line]
    assert observed and not any("xxhash64" in line or "isnull" in line for line in observed)


def test_types_that_do_not_fit_stop_a_load(spark, warehouse):
    day = list_days("2018-04-18", "2018-04-18")
    frame = spark.sql("SELECT 1 AS id, CAST(2 AS DECIMAL(5,2)) AS d, 20180418 AS yymmdd")
    warehouse.stage(frame, "t", day, aligned=True)
    narrower = spark.sql("SELECT CAST(7 AS SMALLINT) AS id, CAST(3 AS DECIMAL(3,1)) AS d, 20180418 AS yymmdd")
    warehouse.stage(narrower, "t", day, aligned=True)
    assert rows(spark.table(warehouse.staging("t")).selectExpr("id", "CAST(d AS INT)")) == [(7, 3)]
    with pytest.raises(TypeError, match="id"):
        warehouse.stage(frame.withColumn("id", F.lit("x")), "t", day, aligned=True)
    kinds = {t: spark.sql(f"SELECT CAST(NULL AS {t}) AS x").schema["x"].dataType for t in
             ("INT", "BIGINT", "DOUBLE", "STRING", "DATE", "DECIMAL(12,2)", "DECIMAL(10,0)", "TIMESTAMP_NTZ")}
    wanted = {("INT", "BIGINT"), ("INT", "DOUBLE"), ("INT", "DECIMAL(12,2)"),
              ("INT", "DECIMAL(10,0)"), ("DECIMAL(10,0)", "DECIMAL(12,2)"), ("DATE", "TIMESTAMP_NTZ")}
    wanted |= {(t, t) for t in kinds} | {(t, "STRING") for t in kinds}
    assert {(a, b) for a in kinds for b in kinds if fits(kinds[a], kinds[b])} == wanted
