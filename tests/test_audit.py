"""Keyed hashes that no plan shows, and the audit of the layers."""

import hashlib
import hmac
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeferry import SNAPSHOT_TABLES, FrameSource, HashKey, leaks, load_snapshot, strict
from lakeferry.functions import masking
from lakeferry.plans.audit import shared_values
from tests.conftest import plan_of, rows

# Key, data and result of published test vectors of HMAC-SHA-256.
VECTORS = [
    (b"\x0b" * 20, "Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"\xaa" * 131, "Test Using Larger Than Block-Size Key - Hash Key First",
     "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
]
KEY = bytes(range(100, 132))


@pytest.mark.parametrize(("key", "data", "wanted"), VECTORS)
def test_published_vectors(spark, key, data, wanted):
    frame = spark.createDataFrame([(data,), ("",), (None,)], "v string")
    got = frame.select(HashKey.of(spark, "k9", key).mask("v").alias("v")).collect()
    assert [r.v for r in got] == [f"k9:{wanted}", "", None]


def test_short_key_of_the_vectors(spark):
    """Too short to be used, but the pads are those of the function."""
    inner, outer = (F.lit(bytearray(x)) for x in masking.hmac_pads(b"Jefe"))
    frame = spark.createDataFrame([("what do ya want for nothing?",)], "v string")
    got = frame.select(masking.keyed_token("v", inner, outer, "k")).first()[0]
    assert got == "k:5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"
    with pytest.raises(ValueError, match="short"):
        HashKey.of(spark, "k", b"Jefe")


def test_as_python_has_it(spark):
    values = ["6222", "é", "王小明", "x" * 1000]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in frame.select(HashKey.of(spark, "a", KEY).mask("v")).collect()]
    assert got == [f"a:{hmac.new(KEY, v.encode(), hashlib.sha256).hexdigest()}" for v in values]


def traces(key):
    """What could give a key away in text."""
    found = []
    for raw in (key, *masking.hmac_pads(key)):
        some = raw[:16]
        found += [some.hex(), some.hex().upper(), some.decode("latin-1"), str(list(some))[1:-1]]
        found += [str(list(some))[1:-1].replace(" ", ""), " ".join(f"{x:02X}" for x in some)]
    return found


def test_explain_shows_no_key(spark):
    key = HashKey.of(spark, "k1", KEY)
    frame = spark.createDataFrame([("6222",)], "v string").select(key.mask("v").alias("v"))
    frame.collect()
    shown = plan_of(frame) + frame._jdf.queryExecution().toString()
    assert "Subquery" in shown and not [x for x in traces(KEY) if x in shown]


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from lakeferry import SNAPSHOT_TABLES, FrameSource, HashKey, Warehouse, load_snapshot, strict
from lakeferry.session import start
from pyspark.sql import functions as F
spark = start("log", {{"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": "file://{folder}", "spark.eventLog.compress": "false", "spark.sql.shuffle.partitions": "2",
    "spark.eventLog.rolling.enabled": "false", "spark.sql.warehouse.dir": "{folder}/warehouse"}})
spec = SNAPSHOT_TABLES["user_bank"]
frame = spark.range(3).select(*[F.lit("6222").alias(c) for c in spec.columns])
warehouse = Warehouse(spark).create("{folder}/lake")
load_snapshot(FrameSource({{"user_bank": frame}}), warehouse, spec, "2018-04-21",
              strict(key=HashKey.of(spark, "k1", bytes(range(100, 132)))))
print(spark.table(warehouse.masked("user_bank")).first().bank_card_id)
spark.stop()
"""


def test_an_event_log_holds_no_key(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    (tmp_path / "events").mkdir()
    script = SCRIPT.format(root=root, folder=tmp_path / "events")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    wanted = hmac.new(KEY, b"6222", hashlib.sha256).hexdigest()
    assert f"k1:{wanted}" in done.stdout, done.stderr[-2000:]
    logs = [p for p in (tmp_path / "events").iterdir() if p.is_file()]
    text = "".join(p.read_text("utf-8", "replace") for p in logs)
    assert "SparkListenerSQLExecutionStart" in text
    assert not [x for x in traces(KEY) if x in text]


def bank(spark, **columns):
    spec = SNAPSHOT_TABLES["user_bank"]
    key = F.col("id").cast("string")
    given = {spec.key: F.col("id"), **dict.fromkeys(spec.datetimes, F.lit("2018-04-20"))}
    given |= {"bank_card_id": F.concat(F.lit("62220000"), key), "bank_kh_name": F.concat(F.lit("name "), key)}
    given |= columns
    other = lambda c: F.concat(F.lit(f"{c} "), F.col("id").cast("string"))
    return spec, spark.range(1000, 1200).select(*[given.get(c, other(c)).alias(c) for c in spec.columns])


def test_a_planted_leak_is_named(spark, warehouse):
    spec, frame = bank(spark)
    plain = next(c for c in spec.columns if c not in {**spec.masks, **spec.strict_masks, spec.key: 0} and c not in spec.datetimes)
    profile = strict(key=HashKey.of(spark, "k1", KEY))
    load_snapshot(FrameSource({"user_bank": frame}), warehouse, spec, "2018-04-21", profile)
    assert rows(leaks(warehouse, spec)) == []
    card = F.when(F.col("id") % 4 == 0, F.concat(F.lit("62220000"), F.col("id").cast("string"))).otherwise(F.lit("none"))
    spec, frame = bank(spark, **{plain: card})
    load_snapshot(FrameSource({"user_bank": frame}), warehouse, spec, "2018-04-21", profile)
    assert rows(leaks(warehouse, spec, bits=1 << 15)) == rows(leaks(warehouse, spec)) == [(plain, "bank_card_id", 50, 50)]


def test_what_a_small_filter_lets_through_is_still_exact(spark):
    """With hardly any bits, all values are suspects; the result is the same."""
    raw = spark.range(3000).select(F.concat(F.lit("raw "), F.col("id").cast("string")).alias("s"), F.lit("xy").alias("t"))
    masked = spark.range(2990, 3300).select(
        F.concat(F.lit("raw "), F.col("id").cast("string")).alias("a"), F.lit("xy").alias("b"), F.lit(7).alias("c")
    )
    for bits in (1 << 15, 1 << 20):
        assert rows(shared_values(masked.union(masked), raw, ["s", "t"], bits=bits)) == [("a", "s", 10, 20)]
    assert rows(shared_values(masked, raw, ["t"], least=1)) == [("b", "t", 1, 310)]
    assert rows(shared_values(masked, raw, [])) == []


def test_only_suspects_are_shuffled(spark):
    raw = spark.range(10).select(F.col("id").cast("string").alias("s"))
    plan = plan_of(shared_values(raw.withColumnRenamed("s", "a"), raw, ["s"], least=1))
    # the layer is read and filtered before any exchange, and Python has no part in it
    assert "EvalPython" not in plan and "MapIn" not in plan and "Generate" in plan
