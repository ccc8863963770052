"""ProbMinHash classes against brute force over shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa

from lakeferry.llm import prob_minhash as pm
from lakeferry.llm.words import Words

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    data = (text or "").encode().lower()
    w = WORD.findall(data)
    if not w:
        return frozenset([("", text or "")])
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def classes(rows):
    """(doc_id, text) -> smallest doc_id of its class."""
    nodes = sorted(set(rows), key=repr)
    sets = [shingles(t) for _, t in nodes]
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, node in enumerate(nodes):
        groups.setdefault(find(i), []).append(node)
    out = {}
    for group in groups.values():
        least = min((d is None, d) for d, _ in group)[1] if any(d is not None for d, _ in group) else None
        out |= {node: (least, len(group)) for node in group}
    return out


def corpus():
    pick = random.Random(11)
    word = lambda: f"w{pick.randrange(400)}"
    rows = [(None, "one two"), (1, None), (2, ""), (3, "..."), (4, "..."), (5, "one two")]
    base = [[word() for _ in range(pick.choice([3, 6, 60, 200]))] for _ in range(60)]
    number = 10
    for words in base:
        for edits in [0, 0, *[pick.randrange(8) for _ in range(6)]]:
            copy = list(words)
            for _ in range(edits):
                copy[pick.randrange(len(copy))] = word()
            number += 1
            rows.append((number, " ".join(copy) + pick.choice(["", "", ".", "\n"])))
    rows += [(9000 + k, " ".join(["same"] * (5 + k))) for k in range(5)]
    rows += rows[100:105]  # repeated rows
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keep_id int")
    wanted = classes([(d, t or "") for d, t in rows])
    found = pm.near_duplicates(frame)
    marks = frame.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS mark")
    texts = {(r.doc_id, r.mark): r.text for r in marks.collect()}
    got = {(r.doc_id, texts[r.doc_id, r.mark]): (r.class_id, r.class_size) for r in found.collect()}
    assert got == wanted
    kept = pm.near_duplicates_removed(frame)
    assert kept.columns == frame.columns
    stays = [(r.doc_id, r.text or "") for r in kept.collect()]
    groups = {}
    for node, value in wanted.items():
        groups.setdefault(value[0] if value[0] is not None else node, []).append(node)
    assert len(stays) == len(set(stays)) == len(groups)
    assert all(wanted[node][0] == node[0] for node in stays)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pm.near_duplicates(none).count() == 0
    assert pm.near_duplicates_removed(none).count() == 0


def test_sketches_estimate_probability_jaccard():
    pick = np.random.default_rng(5)
    size = 2000
    elements = pick.integers(1, 2**63, 60).astype(np.uint64)
    weights = pick.uniform(0.5, 4, (2, 60)) * (pick.random((2, 60)) < 0.8)
    owner = np.repeat([0, 1], 60)
    there = weights.reshape(-1) > 0
    found = pm.sketch(np.tile(elements, 2)[there], weights.reshape(-1)[there], owner[there], 2, size)
    x, y = weights
    exact = sum(
        1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(60))
        for i in range(60)
        if x[i] > 0 and y[i] > 0
    )
    assert abs((found[0] == found[1]).mean() - exact) < 4 * (exact * (1 - exact) / size) ** 0.5


def test_near_pairs_that_repeat_unequally_share_a_band():
    pick = np.random.default_rng(4)
    texts = []
    for _ in range(60):
        words = [f"w{x}" for x in pick.integers(0, 10**9, 250)]
        block, rest = words[:70], words[70:]
        texts += [" ".join(block + rest[:-15]), " ".join(block * 100 + rest)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)],
        names=["doc_id", "mark", "text"],
    )
    bands = [set(x) for out in pm._sketched(iter([batch])) for x in out.column("bands").to_pylist()]
    hashes, _, owner = pm.distinct_shingles(Words(batch.column("text")))
    sets = [set(hashes[owner == i]) for i in range(len(texts))]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2]))
    assert all(a & b for a, b in zip(bands[::2], bands[1::2]))
