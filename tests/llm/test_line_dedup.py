"""Line dedup against all pairs of lines."""

import random

import pytest

from lakeferry.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(pick, text, edits, letters="abcdé日 "):
    text = list(text)
    for _ in range(edits):
        at = pick.randrange(len(text) + 1)
        kind = pick.randrange(3)
        if kind == 0 or not text:
            text.insert(at, pick.choice(letters))
        elif kind == 1:
            del text[min(at, len(text) - 1)]
        else:
            text[min(at, len(text) - 1)] = pick.choice(letters)
    return "".join(text)


@pytest.mark.parametrize("threshold", [1, 2, 3, 7])
def test_within_is_the_edit_distance(threshold):
    pick = random.Random(threshold)
    pairs = [("", ""), ("", "a"), ("a", ""), ("ab", "b"), ("x" * 40, "x" * 41)]
    for _ in range(1500):
        a = "".join(pick.choice("abé") for _ in range(pick.choice([1, 2, 5, 30, 70])))
        pairs.append((a, edited(pick, a, pick.randrange(threshold + 3), "abé")))
        pairs.append((a, "".join(pick.choice("abé") for _ in range(len(a)))))
    a, b = zip(*pairs)
    wanted = [distance(x, y) <= threshold for x, y in pairs]
    assert ld.within(list(a), list(b), threshold).tolist() == wanted


def removed_lines(rows, threshold, min_chars, equal_chars):
    """{(doc_id, text): kept text}, by all pairs of distinct lines."""
    order = sorted({(d is None, d or 0, t) for d, t in rows if t}, key=lambda x: (x[0], x[1]))
    where = {}
    for none, d, t in order:
        for n, line in enumerate(t.split("\n")):
            if len(line) >= equal_chars:
                where.setdefault(line, []).append((none, d, n))
    root = {line: line for line in where}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lines = [line for line in where if len(line) >= min_chars]
    pairs = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if abs(len(a) - len(b)) <= threshold]
    if pairs:
        # the band is held against the plain distance above
        for (a, b), close in zip(pairs, ld.within(*map(list, zip(*pairs)), threshold), strict=True):
            if close:
                root[find(a)] = find(b)
    first = {}
    for line in where:
        first[find(line)] = min(min(where[line]), first.get(find(line), (True, 10**9, 0)))
    out = {}
    for none, d, t in order:
        keep = [
            x for n, x in enumerate(t.split("\n"))
            if len(x) < equal_chars or first[find(x)] == (none, d, n)
        ]
        out[None if none else d, t] = "\n".join(keep)
    return out


@pytest.mark.parametrize("threshold", [1, 2])
def test_only_first_lines_stay(spark, threshold):
    pick = random.Random(9)
    base = ["".join(pick.choice("abcdé日 ") for _ in range(pick.choice([5, 30, 31, 45, 80]))) for _ in range(40)]
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n" + base[0] + "\n"), (5, base[1] + "\r")]
    for d in range(6, 120):
        lines = [edited(pick, pick.choice(base), pick.choice([0, 0, 1, 1, 2, 3])) for _ in range(pick.randrange(1, 6))]
        rows.append((d, "\n".join(lines)))
    rows += [(None, base[2] + "\nshort"), (200, "\n".join(["same line " * 4] * 5)), rows[20], rows[21]]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, gone_id int")
    found = ld.lines_removed(frame, threshold=threshold)
    assert found.columns == frame.columns
    wanted = removed_lines(rows, threshold, ld.MIN_CHARS, ld.EQUAL_CHARS)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=key)
    assert got == sorted(((d, wanted[d, t] if t else t) for d, t in rows), key=key)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ld.lines_removed(none, removed="n").collect() == []


def test_changed_numbers_and_short_equal_lines(spark):
    long_ = "This page was last edited by the staff on the {}th of May"
    texts = [long_.format(n) + f"\nShare this article\nown {n}" for n in (12, 37)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.text for r in ld.lines_removed(docs).collect()}
    assert kept == {0: texts[0], 1: "own 37"}


def thue_morse(size, letters):
    return "".join(letters[n.bit_count() & 1] for n in range(size))


@pytest.mark.parametrize("size", [1024, 4096, 16384])
def test_lines_that_defeat_sums_modulo_a_power_of_two(spark, size):
    texts = [thue_morse(size, "ab"), thue_morse(size, "ba")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in ld.lines_removed(docs).collect()} == dict(enumerate(texts))
