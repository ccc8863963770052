"""Mixing against plain water-filling and running sums."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeferry.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents():
    pick = random.Random(3)
    rows = [(None, "a b", "s1", 7), (5, None, "s1", 7), (6, "", None, 7), (6, " \t", "s2", 7)]
    for i in range(10, 900):
        source = pick.choice(["s1"] * 20 + ["s2", "é", "z", None, "s2"])
        rows.append((i, "w " * pick.choice([0, 1, 3, 50]) + "x", source, 7))
    return rows + rows[40:60]


def filled(sizes, weights):
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        left, weight = total - sum(capped.values()), sum(weights[s] for s in rest)
        share = {s: left * weights[s] / weight for s in rest}
        over = {s: 2 * sizes[s] for s in rest if share[s] > 2 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped |= over


def test_takes_come_to_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rows = documents()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, TAKEN int")
    found = mixing.planned(frame).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    wanted = filled(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    sums = {}
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r.size == 2 * len(WORD.findall(r.text or ""))
        assert sum(c.taken for c in r.copies) == r.taken
        assert all(0 < c.position < 1 for c in r.copies)
        sums[r.source] = sums.get(r.source, 0) + r.taken
    assert sums == {s: round(t) for s, t in wanted.items()}
    again = mixing.planned(frame.repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert [key(r) for r in sorted(again, key=key)] == [key(r) for r in sorted(found, key=key)]


def test_positions_follow_the_schedules(spark):
    rows = [(i, "w " * 9, f"s{i % 3}", 0) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    copies = mixing.mixed(frame).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies)
    for k, schedule in enumerate(mixing.SCHEDULES):
        mine = [c for c in copies if c.source == f"s{k}"]
        words = sum(c.taken for c in mine)
        for until in (0.25, 0.5, 0.8):
            area = mixing.integral([p for p in cut(schedule, until)])
            taken = sum(c.taken for c in mine if c.position < until)
            assert taken / words == pytest.approx(area / mixing.integral(schedule), abs=0.02)
    partial = [c for c in copies if c.taken < 9]
    assert all(len(c.text.split()) == c.taken for c in partial)


def cut(schedule, until):
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        yield t0, w0
        if t1 >= until:
            yield until, w0 + (w1 - w0) * (until - t0) / (t1 - t0)
            return


def test_empty_and_wordless_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mixed(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.planned(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema)).collect()
    assert [(r.taken, r.target, r.position) for r in rows] == [(0, 0.0, None)] * 2


def test_documents_without_a_number_are_spread(spark):
    """A third of all rows without doc_id, and a third of one doc_id, fill no bucket more than others."""
    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else n, "s", f"text number {n}") for n in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    seen = []
    real = mixing.Scratch.save

    def save(self, frame, name):
        seen.append(frame)
        return real(self, frame, name)

    mixing.Scratch.save, before = save, mixing.Scratch.save
    try:
        plan = mixing.planned(docs, carry=["doc_id"])
    finally:
        mixing.Scratch.save = before
    buckets = seen[0].groupBy(F.floor(F.col("rank") * 8)).count().collect()
    assert len(buckets) == 8 and max(r["count"] for r in buckets) < 1.2 * 30_000 / 8
    found = plan.agg(F.sum("size"), F.sum("taken"), F.max("source_size")).first()
    assert tuple(found) == (90_000, 135_000, 90_000)
