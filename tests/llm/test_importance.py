"""Importance resampling against a plain version of it."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeferry.llm import importance

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def features(text, longest):
    words = [w.lower() for w in _WORD.findall((text or "").encode())]
    return [b" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed="2024"):
    """(doc_id, n_features, weight, score, rank) of each row; ties of doc_id are not told apart."""
    bucket = lambda x: zlib.crc32(x) % buckets
    raw = Counter(bucket(x) for _, t in rows for x in features(t, longest))
    wanted = Counter(bucket(x) for t in target for x in features(t, longest))
    n_raw, n_wanted = sum(raw.values()), sum(wanted.values())
    out = []
    for d, t in rows:
        mine = [bucket(x) for x in features(t, longest)]
        gain = [
            math.floor(1000 * math.log((wanted[b] + 1) * (n_raw + buckets) / ((raw[b] + 1) * (n_wanted + buckets))))
            for b in mine
        ]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(mine), weight, score, None, len(features(t, 1)) >= least])
    able = sorted((r for r in out if r[-1]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = place + 1
    return [tuple(r[:5]) for r in out]


def texts():
    pick = random.Random(11)
    words = ["Word%d" % n for n in range(60)] + ["é", "日本", "x" * 70, "x" * 64, "x" * 65]
    rows = [(d, " ".join(pick.choice(words) for _ in range(pick.choice([0, 3, 19, 20, 21, 50])))) for d in range(300)]
    rows += [(None, rows[-1][1]), (500, None), (501, ""), (502, "-,;\n\t")]
    return rows, [" ".join(words[:9]), None, "", "Word1, word1; é"]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_all_numbers(spark, longest):
    rows, target = texts()
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, SCORE int, down int")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(docs.repartition(5), wanted, longest=longest)
    assert found.columns == ["doc_id", "text", "down", "n_features", "weight", "score", "rank"]
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, target, longest), key=repr)


def test_runs_do_not_cross_texts():
    column = pa.array(["a b", None, "c", "d e f"])
    found, owner = importance.feature_buckets(column, 2, 1 << 32)
    wanted = [b"a", b"b", b"c", b"d", b"e", b"f", b"a b", b"d e", b"e f"]
    assert found.tolist() == [zlib.crc32(x) for x in wanted]
    assert owner.tolist() == [0, 0, 2, 3, 3, 3, 0, 3, 3]


def test_repeated_and_equal_rows_fill_the_draw_exactly(spark):
    same = " ".join(["word"] * 30)
    rows = [(7, same)] * 55 + [(7, same + " more")] * 25 + [(8, same)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = importance.resampled(docs, docs.select("text"), percent=50).collect()
    drawn = sorted((r["rank"], -r.score) for r in found if r["rank"])
    assert [rank for rank, _ in drawn] == list(range(1, 61))
    assert [score for _, score in drawn] == sorted(-r.score for r in found)[:60]


def test_cutoff_by_counts(spark):
    pick = random.Random(2)
    rows = [(pick.choice([-(2**62), -5, 0, 3, 3, 3, 2**62]), pick.randrange(4), n) for n in range(90)]
    frame = spark.createDataFrame(rows, "a long, b long, c long")
    for wanted in (1, 2, 30, 47, 89, 90):
        chosen = frame.where(importance.first_rows(frame, ["a", "b", "c"], wanted)).collect()
        assert sorted(map(tuple, chosen)) == sorted(rows)[:wanted]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(docs, docs.select("text")).count() == 0
    rows = [(n, " ".join(["a"] * 25)) for n in range(10)]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    found = importance.resampled(some, docs.select("text"))
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, []), key=repr)
    few = importance.resampled(some.limit(9), some.select("text"))
    assert few.where(F.col("rank").isNotNull()).count() == 0
