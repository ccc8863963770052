"""NN-descent against all pairs."""

import numpy as np
import pytest

from lakeferry.llm import nn_descent as nd
from lakeferry.llm.scratch import Scratch

plain = nd.neighbour_lists


def brute(rows):
    """{(vec_id, vector): (n_links, component_id)}."""
    nodes = list({(i, None if v is None else tuple(v)): None for i, v in rows})
    units = []
    for _, v in nodes:
        good = v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.zeros(16)
        if good:
            x[: len(v)] = np.array(v) / max(map(abs, v))
        units.append(x / (np.linalg.norm(x) if good else 1))
    near = np.array(units) @ np.array(units).T >= 0.9
    np.fill_diagonal(near, False)
    root = list(range(len(nodes)))
    for _ in nodes:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(near[i]))]) for i in range(len(nodes))]
    ids = {}
    for i, node in enumerate(nodes):
        known = [x for x in (ids.get(root[i]), node[0]) if x is not None]
        ids[root[i]] = min(known, default=None)
    return sorted(((node[0], int(near[i].sum()), ids[root[i]]) for i, node in enumerate(nodes)), key=repr)


def rows():
    pick = np.random.default_rng(3)
    out = [(i, pick.standard_normal(16)) for i in range(300)]
    for c, n in enumerate((2, 3, 40, 900)):
        centre = pick.standard_normal(16)
        out += [(1000 * (c + 1) + i, centre + 0.2 * pick.standard_normal(16)) for i in range(n)]
    out = [(i, [float(x) for x in v]) for i, v in out]
    same = out[3][1]
    out += [(5000 + i, same) for i in range(50)] + [(5100, [2 * x for x in same])]
    out += [(6000, None), (6001, []), (6002, [0.0] * 16), (6003, [1.0, None]), (6004, [float("nan")] * 16)]
    out += [(6005, [float("inf"), 1.0]), (6006, [1e300] * 16), (6007, [1e-300] * 16), (6008, [3.0])]
    out += [(None, same), out[0], out[0]]
    return out


def test_links_are_those_of_all_pairs(spark):
    data = rows()
    frame = spark.createDataFrame([(*r, 1) for r in data], "vec_id long, embedding array<double>, id int")
    found = nd.linked_vectors(frame).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == brute(data)


def test_empty_and_lonely(spark):
    schema = "vec_id long, embedding array<float>"
    assert nd.linked_vectors(spark.createDataFrame([], schema)).count() == 0
    one = nd.linked_vectors(spark.createDataFrame([(7, [1.0, 2.0])], schema)).collect()
    assert [tuple(r) for r in one] == [(7, 0, 7, True)]


def test_recall_of_given_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    found = {r.vec_id: r.n_links for r in nd.linked_vectors(vectors).collect()}
    ids, all_ = zip(*[(r.vec_id, r.embedding) for r in vectors.collect()])
    x = np.array(all_, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    queries = [k for k, i in enumerate(ids) if i % 20 == 0]
    near = (x[queries] @ x.T >= 0.9).sum(1) - 1
    got = sum(min(found[ids[k]], n) for k, n in zip(queries, near))
    assert got >= 0.9 * near.sum()


def near_groups(n, centres, inside=0.99, width=64):
    """n near copies of each centre, with cosines of about `inside` among them."""
    pick = np.random.default_rng(7)
    noise = pick.standard_normal((len(centres) * n, width))
    noise[:, : len(centres[0])] = 0
    noise *= np.sqrt(1 / inside - 1) / np.linalg.norm(noise, axis=1, keepdims=True)
    noise[:, : len(centres[0])] = np.repeat(centres, n, axis=0)
    return [(i, [float(x) for x in row]) for i, row in enumerate(noise)]


def test_links_that_leave_full_lists(spark):
    far = 0.91 / 0.99  # every list is full of its own group; all of the other are linked, too
    data = near_groups(100, [[1, 0], [far, np.sqrt(1 - far**2)]])
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = nd.linked_vectors(frame).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(199, 0)}


def test_far_components_are_not_searched(spark, monkeypatch):
    searched = []
    monkeypatch.setattr(nd, "neighbour_lists", lambda *a, **b: searched.append(a[5]) or plain(*a, **b))
    data = near_groups(60, [[1, 0, 0], [0, 1, 0], [0, 0, 1]])
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    found = nd.linked_vectors(frame).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(59, 0), (59, 60), (59, 120)}
    assert not [name for name in searched if "across" in name] and any("near" in name for name in searched)


def test_components_that_may_be_linked(spark, tmp_path):
    rows = near_groups(20, [[1, 0, 0, 0], [0.8, 0.6, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]])
    unit = lambda v: bytearray((np.array(v) / np.linalg.norm(v)).astype(np.float32).tobytes())
    frame = spark.createDataFrame([(i, unit(v), i // 20) for i, v in rows], "id long, coarse binary, component long")
    # 37 degrees apart, radii of some 6 degrees, links of 26 degrees
    near = nd.near_components(frame.repartition(3), 64, 4, 0, 0.9, Scratch(spark), "t").collect()
    assert {r.component for r in near} == {0, 1}


def audited(spark, lost):
    """Recall where one large group is complete and 100 pairs are not, `lost` of them."""
    data = near_groups(600, [[1.0, 0.0]], width=128)
    pick = np.random.default_rng(8)
    for i in range(100):
        one = pick.standard_normal(128)
        data += [(1000 + 2 * i, list(map(float, one))), (1001 + 2 * i, list(map(float, one * 1.5 + 0.01)))]
    ids = [i for i, _ in data]
    exact = [(np.array(v) / np.linalg.norm(v)).tobytes() for _, v in data]
    units = spark.createDataFrame([(i, bytearray(e), 1) for i, e in zip(ids, exact)], "id long, exact binary, times long")
    pairs = [(i, i // 2 * 2, 2, 1) for i in ids[600 + 2 * lost :]]
    found = spark.createDataFrame([(i, 0, 600, 599) for i in ids[:600]] + pairs, "id long, component long, size long, n long")
    return nd.recall(units, found)


def test_audit_sees_loss_beside_a_large_group(spark):
    assert audited(spark, 0) == 1
    assert audited(spark, 50) < nd.TARGET


def test_no_result_below_target(spark, monkeypatch):
    monkeypatch.setattr(nd, "recall", lambda *_: 0.5)
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1])], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="0.500"):
        nd.linked_vectors(frame)
