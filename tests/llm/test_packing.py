"""Packing against the tokenizer itself, an exact round trip, and sums of squares by hand."""

import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeferry.llm import packing
from lakeferry.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def checked(rows, wanted, window=packing.WINDOW):
    """Pieces give back each document's ids, and sequences are full or powers of two.

    `wanted` has the ids of each document by its number.
    """
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert docs.keys() == wanted.keys()
    for number, ids in wanted.items():
        at = 0
        for r in sorted(docs[number], key=lambda r: r["start"]):
            body = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(body), len(ids))
            assert "ids" not in r or r["ids"] == body
            at += r["length"]
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == window or at < window and at & (at - 1) == 0


def test_ids_are_the_tokenizers(tokenizer):
    encoder, pick = packing.Encoder(Path(PATH).read_text("utf-8")), random.Random(3)
    texts = ["", "a", " ", "\n\n a  b   c", "<|endoftext|> x", "it's,don't!\x1c\x85", "x" * 5000]
    letters = "ab!1.,'s \n\t\r\x0b\x1c\x85 　é日\U0001f600"
    texts += ["".join(pick.choice(letters) for _ in range(40)) for _ in range(500)]
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert list(ids) == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_remembered_units_may_be_forgotten(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "REMEMBER", 3)
    encoder = packing.Encoder(Path(PATH).read_text("utf-8"))
    for text in ("one two three four five", "five four three", "one two six", "") * 2:
        assert list(encoder.ids([text])[0][:-1]) == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.units) <= 3


def test_levels_are_those_of_the_least_sum_of_squares():
    pick = random.Random(7)
    for _ in range(400):
        window = 16
        counts = np.array([0, *(pick.choice([0, 0, 1, 2, 5]) for _ in range(window - 1)), 0])
        size = pick.randrange(1, window)
        sums = {}
        for level in range(window - size + 1):
            if level and not counts[level]:
                continue
            after = counts.copy()
            after[level] -= level > 0
            if level + size < window:
                after[level + size] += 1
            sums[level] = int((after**2).sum())
        best = max(level for level, total in sums.items() if total == min(sums.values()))
        assert packing.best_level(counts.copy(), size) == best


@pytest.mark.parametrize("most", [2, 5, 1024])
@pytest.mark.parametrize("sizes", ["mixed", "over half", "whole", "ones"])
def test_any_sizes_are_packed_whole(most, sizes):
    pick, window = random.Random(most), 64
    size = {
        "mixed": lambda: pick.choice([1, 2, 7, 30, 33, 63, 64, 65, 200]),
        "over half": lambda: 33,
        "whole": lambda: 128,
        "ones": lambda: 1,
    }[sizes]
    docs = {n: list(range(n, n + size())) for n in range(300)}
    rows, closed = [], []

    def close(pieces):
        assert pieces
        closed.append(pieces)
        at = 0
        for p in pieces:
            body = p.ids.tobytes()
            rows.append(
                {"doc_id": p.doc[0], "start": p.start, "length": len(p.ids), "ids_crc32": zlib.crc32(body),
                 "doc_tokens": p.doc[1], "sequence_id": len(closed), "offset": at}
            )
            at += len(p.ids)

    packer = packing.Packer(close, window, most)
    for number, ids in docs.items():
        packer.add((number, len(ids)), np.array(ids, "<u4"))
        assert packer.open < most and packer.open == packer.counts.sum() == sum(map(len, packer.levels))
    packer.end()
    checked(rows, docs, window)
    tokens = sum(map(len, docs.values()))
    assert len(closed) <= tokens // window + 6  # and what the last window is cut into


def test_odd_rows(spark, tokenizer):
    long_ = "many words, and more of them. " * 20_000
    rows = [(None, "no number", 1), (1, None, 1), (2, "", 1), (3, long_, 1), (4, "é日\n\n x", 1), (5, "x" * 9000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, START int").repartition(3)
    found = packing.packed(docs, Path(PATH).read_text("utf-8"))
    assert found.columns == ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t, _ in rows}
    checked([r.asDict() for r in found.collect()], ids)
    assert packing.packed(docs.where("1 = 2"), Path(PATH).read_text("utf-8")).count() == 0


def test_repeated_rows_are_documents_each(spark):
    docs = spark.createDataFrame([(7, "some words")] * 5, "doc_id long, text string").coalesce(1)
    rows = packing.packed(docs, Path(PATH).read_text("utf-8"), window=8).collect()
    tokens = rows[0].doc_tokens
    assert sum(r.length for r in rows) == 5 * tokens and {r.doc_tokens for r in rows} == {tokens}


def test_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in docs}
    checked([r.asDict() for r in QUERIES["op11_packing"](spark, sf).collect()], ids)
