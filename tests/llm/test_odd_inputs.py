"""Every operator on documents over a table of odd rows: it runs, and loses no row it should keep."""

import pytest

from lakeferry.llm import (
    decontaminate,
    line_dedup,
    mixing,
    prob_minhash,
    quality,
    suffix_dedup,
    token_counts,
)

#: names that the operators use themselves, inside or for results
CLASHING = (
    "id key mark tag at low high first component a b row rows size source_size target taken position "
    "copies copy score predicted kept n_bytes n_removed n_spans kept_sha256 n_words n_hit n_items "
    "items_sha256 contaminated spans items n_tokens word_count hit_spans keep_id keep_mark gone_id "
    "gone_lines bands line start times strings segment class_id wanted text_ f n"
).split()
LONG = "long words and more of them, " * 40_000  # 1.2 MB, one line

ROWS = [
    (None, None, None, None, None),
    (1, None, "en", "s", 0),
    (2, "", None, "s", 0),
    (3, " \n\n\t", "en", None, 4),
    (4, LONG, "en", "s", len(LONG)),
    (5, "x" * 300_000, "en", "s", 300_000),
    (6, "日本語 é\u0000 \U0001f600 " * 50, "ja", "t", 1),
    (7, "a plain text of some words, which nothing else says", "en", "t", 1),
    (8, "a line that is said here, and it is long\nand another one that is said only here", "en", "t", 1),
    (9, "a line that is said here, and it is long\nand yet another that nobody says at all", "en", "t", 1),
    (9, "a line that is said here, and it is long\nand yet another that nobody says at all", "en", "t", 1),
    (9, "the same number, but another text than the one above", "en", "t", 1),
    (None, "a text without a number, but with words in it", "en", "t", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", *[f"{n} AS {name}" for n, name in enumerate(CLASHING)])


def identities(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


ALL = sorted([(r[0], r[1]) for r in ROWS], key=repr)


def same_rows(frame):
    assert len({c.lower() for c in frame.columns}) == len(frame.columns)
    assert identities(frame) == ALL


def test_row_by_row_operators(spark, docs):
    bench = spark.createDataFrame([(1, LONG[:300]), (None, None), (2, "")], "item_id long, text string")
    found = decontaminate.report(docs, bench)
    same_rows(found)
    assert {r.doc_id for r in found.collect() if r.contaminated} == {4}
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns
    same_rows(quality.scored(docs, quality.Model()))
    same_rows(token_counts.counted(docs, [(97,), (98,)]))


def test_mixing(docs):
    same_rows(mixing.planned(docs))
    copies = mixing.mixed(docs)
    assert len({c.lower() for c in copies.columns}) == len(copies.columns)
    assert all(r.taken > 0 for r in copies.collect())


def test_suffix_dedup(docs):
    found = suffix_dedup.repeats_removed(docs)
    same_rows(found)
    rows = {r.doc_id: r for r in found.collect() if r.doc_id in (4, 5, 7)}
    # of a text that repeats with a period, its first 99 bytes and one period stay
    assert rows[4].n_bytes - rows[4].n_removed == 29
    assert rows[5].n_bytes - rows[5].n_removed == 1
    assert rows[7].n_removed == 0


def test_line_dedup(docs):
    found = line_dedup.lines_removed(docs, removed="gone")
    assert found.columns == [*docs.columns, "gone"]
    gone = {(r.doc_id, tuple(r.gone)) for r in found.collect() if r.gone}
    assert gone == {(9, (0,))}


def test_near_duplicates(docs):
    kept = prob_minhash.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    # null and empty texts are copies of each other; a repeated row is one document
    wanted = [x for x in dict.fromkeys(ALL) if x not in ((None, None), (2, ""))]
    assert identities(kept) == sorted(wanted, key=repr)
