"""Suffix-array dedup against a dictionary of all 100-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from lakeferry.llm import suffix_dedup as sd


def brute(rows):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}."""
    nodes = sorted({(d is None, d or 0, t or "") for d, t in rows})
    first, out = {}, {}
    for none, d, t in nodes:
        data = t.encode()
        gone = np.zeros(len(data) + 2, int)
        for p in range(len(data) - 99):
            key = data[p : p + 100]
            if first.setdefault(key, (none, d, p)) != (none, d, p):
                gone[p + 1 : p + 101] = 1
        kept = bytes(b for b, g in zip(data, gone[1:]) if not g)
        spans = int((np.diff(gone) == 1).sum())
        out[None if none else d, t] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    pick = random.Random(5)
    text = lambda n, letters="abcdefgh é日": "".join(pick.choice(letters) for _ in range(n))
    passages = [text(pick.choice([99, 100, 101, 150, 400])) for _ in range(12)]
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 5000), (6, "ab" * 300)]
    for d in range(10, 90):
        parts = [text(pick.choice([0, 3, 50, 200]))]
        for _ in range(pick.randrange(4)):
            passage = list(pick.choice(passages))
            for _ in range(pick.choice([0, 0, 1, 2])):
                passage[pick.randrange(len(passage))] = pick.choice("abc")
            low = pick.choice([0, 0, 20])
            parts += ["".join(passage[low:]), text(pick.choice([0, 1, 60]))]
        rows.append((d, "".join(parts)))
    core = text(60)  # a common phrase in many contexts, some of them equal
    ends = [text(70) for _ in range(40)]
    for d in range(200, 330):
        rows.append((d, pick.choice(ends) + core + pick.choice(ends)))
    rows += [(400 + k, rows[20][1]) for k in range(5)] + [(None, rows[21][1]), (None, text(300))]
    rows += [rows[30], rows[30], (41, passages[3] * 3)]
    return rows


@pytest.mark.parametrize(("most", "blocks"), [(sd.MOST, sd.BLOCKS), (3, sd.BLOCKS), (1, (31, 7, 1))])
def test_bytes_are_those_of_all_strings(spark, monkeypatch, most, blocks):
    monkeypatch.setattr(sd, "MOST", most)
    monkeypatch.setattr(sd, "BLOCKS", blocks)
    rows = corpus()
    # `mark` orders texts of one doc_id; here they differ in doc_id or are equal
    rows = [r for r in rows if r[0] != 41] + [(42_000, rows[-1][1])]
    rows = [r for n, r in enumerate(rows) if r[0] is not None or r == (None, rows[n][1]) and n % 2]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, KEPT int").repartition(7)
    found = sd.repeats_removed(frame).collect()
    key = lambda r: repr(r)
    wanted = brute(rows)
    got = [(r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]
    assert sorted(got, key=key) == sorted(((d, t, *wanted[d, t or ""]) for d, t in rows), key=key)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


@pytest.mark.parametrize("block", [1, 4, 16, 31])
def test_a_block_is_divided_by_what_its_strings_share(block):
    """By blocks of one string, a group has equal strings only, so divisions end."""
    pick = random.Random(1)
    body = bytes(pick.choice(b"ab") for _ in range(160))
    bodies = [body, body[:150] + b"c" + body[151:], body]
    at = [sd._packed(0, 0, 61, 60)] * 3
    table = sd.pa.table({"key": [7] * 3, "doc_id": [1, 2, 3], "at": at, "body": bodies})
    found = sd._dividers(sd.Pieces(table), block).reshape(3, 61)
    assert (found[0] == found[2]).all()
    # byte 150 is in the strings from 51 on; a block has it in common if its first string does
    first = [max(n // block * block, 0) for n in range(61)]
    assert [bool(x) for x in found[0] == found[1]] == [n + 100 <= 150 for n in first]
    assert len(set(found[0].tolist())) == -(-61 // block)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sd.repeats_removed(none).count() == 0
