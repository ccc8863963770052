"""The Merkle manifest against a plain tree over sorted leaves."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakeferry.llm import manifest
from lakeferry.llm.scratch import Scratch


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def tree(nodes):
    """The last node, and the path of each."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, place in enumerate(at):
            first = place // 3 * 3
            paths[n] += ["".join(nodes[first:place]), "".join(nodes[place + 1 : first + 3])]
            at[n] = place // 3
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def changed(row):
    d, *rest, text = row
    if d is None or text is None or zlib.crc32(str(d).encode()) % 2:
        return row
    return (d, *rest, text.replace("\n", ""))


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in sources}
    root, above = tree([trees[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above, strict=True):
        for place, (r, path) in enumerate(zip(groups[s], trees[s][1], strict=True)):
            node = leaf(changed(r))
            for before, behind in zip((path + up)[::2], (path + up)[1::2], strict=True):
                node = h(before, node, behind)
            out.append((r[0], s, place, leaf(r), trees[s][0], root, tuple(path + up), h(*path, *up), node, node == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def run(spark, rows, proofs=True):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{SCHEMA}, GRP int, node int").repartition(5)
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = manifest.leaf_digest([*[F.col(c) for c in manifest.FIELDS[:-1]], text])
    found = manifest.proven(frame, claimed, proofs=proofs)
    return [(*r[:6], tuple(r[6]) if r[6] is not None else None, *r[7:]) for r in map(tuple, found.collect())]


def table(n, seed=1):
    pick = random.Random(seed)
    rows = []
    for d in range(n):
        number = pick.choice([d, d * 1000, -d, d + 10**15, None if d % 9 == 0 else d])
        source = pick.choice(["a", "a", "a", "é", None, "", "日", f"s{d % 40}"])
        text = pick.choice([None, "", "x\ny", f"text {d}\n", "é\n\n"])
        rows.append((number, source, pick.choice(["en", None]), pick.choice([None, 3]), text))
    return rows


@pytest.mark.parametrize("n", [1, 4, 28, 400])
def test_any_number_of_rows(spark, n):
    rows = table(n)
    assert sorted(run(spark, rows), key=repr) == sorted(brute(rows), key=repr)


def test_one_source_of_full_arrays(spark):
    rows = [(d, "s", "en", 1, f"{d}\n") for d in range(3**7 + 1)]
    assert sorted(run(spark, rows), key=repr) == sorted(brute(rows), key=repr)


def test_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(manifest, "COPIES", 7)
    rows = [(5, "s", "en", 1, "a\nb")] * 40 + [(5, "s", "en", 1, f"{n}") for n in range(60)]
    rows += [(d, "s", "en", 1, "c") for d in range(12)] + [(None, "s", None, None, None)] * 15
    rows += [(None, None, "en", n, "n\n") for n in range(20)] + [(6, None, "en", 1, "z")] * 2
    assert sorted(run(spark, rows), key=repr) == sorted(brute(rows), key=repr)


def test_without_proofs_and_empty(spark):
    rows = table(50)
    found = run(spark, rows, proofs=False)
    assert all(r[6] is None for r in found)
    drop = lambda rows: sorted((r[:6] + r[7:] for r in rows), key=repr)
    assert drop(found) == drop(brute(rows))
    assert run(spark, []) == []


def test_directory_of_many_levels(spark, monkeypatch):
    monkeypatch.setattr(manifest, "FAN", 2)
    pick = random.Random(4)
    ids = pick.sample(range(-(10**12), 10**12), 300) + list(range(200))
    rows = spark.createDataFrame([(n % 3, i, i) for n, i in enumerate(ids)], "grp long, id long, same long")
    scratch = Scratch(spark)
    held = manifest.containers(manifest.word_bitmaps(rows))
    found = manifest.ranked(rows, manifest.directory(scratch.save(held, "held"), scratch))
    for g in range(3):
        mine = sorted(i for n, i in enumerate(ids) if n % 3 == g)
        got = {r.id: r.pos for r in found.where(f"grp = {g}").collect()}
        assert got == {i: n for n, i in enumerate(mine)}


def test_a_changed_claim_is_not_verified(spark):
    rows = [(d, "s", "en", 1, "t") for d in range(10)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert manifest.proven(frame).where("verified").count() == 10
    wrong = F.when(F.col("doc_id") == 4, F.sha2(F.lit("other"), 256))
    found = manifest.proven(frame, wrong).where("NOT verified").collect()
    assert [r.doc_id for r in found] == [4]
