"""Decontamination against plain Python over windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from lakeferry.llm import decontaminate as dc

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    data = (text or "").encode()
    return WORD.findall(bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in data))


def brute(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        if len(w) >= 13:
            windows += [(str(item), w[i : i + 13]) for i in range(len(w) - 12)]
        elif w:
            windows.append((str(item), w))
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, window in windows:
            n = len(window)
            for i in range(len(w) - n + 1):
                if w[i : i + n] == window:
                    hit |= set(range(i, i + n))
                    found.add(item)
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc, len(w), len(hit), len(found), names, bool(hit) and 20 * len(hit) >= len(w)


def cases():
    pick = random.Random(7)
    vocabulary = ["a", "B", "cé", "日本", "x1", "the", "of"]
    text = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    items = [(i, text(pick.choice([0, 1, 3, 12, 13, 14, 30]))) for i in range(20)]
    items += [(21, None), (22, ""), (3, text(15))]
    docs = [(1, None), (2, ""), (3, "!?"), (4, text(3000)), (4, text(13))]
    for i in range(5, 60):
        item = pick.choice(items)[1] or ""
        cut = item.split(" ")[: pick.choice([3, 12, 13, 40])]
        docs.append((i, text(pick.choice([0, 5, 300])) + ", " + "; ".join(cut) + ".\n" + text(9)))
    docs += [(100 + i, items[4][1]) for i in range(5)]
    return docs, items


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("limit", [dc.BLOCK_BYTES, 200])
def test_report_is_what_windows_give(spark, limit):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 as spans_", "'x' as WORD_COUNT", "2 as hit_items"
    )
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.report(frame, bench, block_bytes=limit)
    assert sorted(map(tuple, found.select(*COLUMNS).collect())) == sorted(brute(docs, items))
    kept = dc.decontaminate(frame, bench, block_bytes=limit)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        x[0] for x in brute(docs, items) if not x[-1]
    )


def test_empty_tables(spark):
    docs, items = cases()
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert dc.report(none, bench).count() == 0
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in dc.report(frame, empty).collect()} == {0}
    assert dc.longest_matches(frame, empty).count() == 0


def test_suffix_array_is_sorted():
    pick = np.random.default_rng(1)
    for size in (0, 1, 5, 400):
        for kinds in (2, 5, 100):
            w = pick.integers(0, kinds, size)
            tail = lambda p: list(w[p : p + np.argmin(np.append(w[p:], 0))])
            found = dc.suffix_array(w, size + 1)
            assert [tail(p) for p in found] == sorted(tail(p) for p in np.flatnonzero(w))


def test_longest_matches(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([x for x in items if x[0] != 3], "item_id long, text string")
    texts = [(str(d), words(t)) for d, t in docs]
    wanted = {}
    for item, text in items:
        w = words(text)
        for i in range(len(w) if item != 3 else 0):
            best = 0
            for _, t in texts:
                while any(t[p : p + best + 1] == w[i : i + best + 1] for p in range(len(t) - best)):
                    if i + best >= len(w):
                        break
                    best += 1
            if best:
                wanted[str(item), i] = best
    found = dc.longest_matches(frame, bench).collect()
    assert {(r.item, r.item_word): r.n_words for r in found} == wanted
    by_doc = {}
    for d, t in texts:
        by_doc.setdefault(d, []).append(t)
    for r in found:
        w = words(dict((str(i), t) for i, t in items)[r.item])[r.item_word :][: r.n_words]
        assert any(t[r.doc_word : r.doc_word + r.n_words] == w for t in by_doc[r.doc])


@pytest.mark.parametrize("item", [["the"] * 200, ["a", "b"] * 100])
def test_repeated_words_make_no_product(item):
    """A window is looked at once, however often it stands in the item, and a place once a length."""
    import pyarrow as pa

    bench = dc.Benchmark(pa.table({"item": ["1", "2"], "text": [" ".join(item), item[0]]}))
    page = (item * 100)[:8000]
    shard = dc.Shard(pa.array([" ".join(page), "other words", " ".join(item[:5])]), bench)
    low, high, length, owners = shard.windows()
    assert len(low) == len(set(item)) + 1 and sum(high - low) <= 2 * 8005
    spans, items = shard.spans()
    assert spans[0] == [0, 8000] and spans[1] == [] and items == [["1", "2"], [], ["2"]]


def test_many_items_of_one_window(spark):
    docs = [(1, "x " * 4000), (2, "y x"), (3, "y")]
    items = [(n, "x") for n in range(100)] + [(200, "y x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.report(frame, bench).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(brute(docs, items))
