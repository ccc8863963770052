"""Components against a plain union-find."""

import random

import pytest

from lakeferry.llm.linking import components
from lakeferry.llm.scratch import Scratch


def plain(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up if top(x) != x}


def found(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    saved = []

    class Counting(Scratch):
        def save(self, frame, name):
            saved.append(name)
            return super().save(frame, name)

    rows = components(frame, Counting(spark), "t").collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.component for r in rows}, len(saved)


@pytest.mark.parametrize("shape", ["chain", "random", "trees", "two stars"])
def test_components(spark, shape):
    rng = random.Random(shape)
    edges = {
        "chain": [(x, x + 1) for x in rng.sample(range(40), 40)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "trees": [(x, rng.randrange(x - 9, x)) for x in range(10, 200)],
        "two stars": [(x, x % 2 * 500) for x in range(100)] + [(700, 500), (-3, 0)],
    }[shape]
    got, _ = found(spark, edges + edges[:5] + [(b, a) for a, b in edges[5:9]])
    assert got == plain(edges)


def test_stars_take_no_round(spark):
    edges = [(5, x) for x in range(6, 60)] + [(x, 1) for x in range(100, 130)] + [(4, 4)]
    got, saved = found(spark, edges)
    assert got == plain(edges) and saved == 1


def test_no_edges(spark):
    assert found(spark, []) == ({}, 1)
