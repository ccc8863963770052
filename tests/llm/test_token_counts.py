"""The automaton against greedy longest match, piece by piece."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeferry.llm import token_counts as tc


def greedy(tokens, word):
    rest, pieces = (*word.encode(), tc.END), 0
    while rest:
        n = max((n for n in range(1, len(rest) + 1) if rest[:n] in tokens), default=0)
        if not n:
            return 1
        rest, pieces = rest[n:], pieces + 1
    return pieces


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abc", min_size=1, max_size=4), max_size=25),
    st.sets(st.text("abc", max_size=3), max_size=8),
    st.lists(st.text("abcd", min_size=1, max_size=12), max_size=10),
)
def test_any_vocabulary(inner, final, words):
    tokens = {tuple(t.encode()) for t in inner} | {(*t.encode(), tc.END) for t in final}
    automaton = tc.Automaton(tokens)
    for word in words:
        assert automaton.count(word) == greedy(tokens, word)


def test_public_vocabulary():
    tokens = set(tc.read_vocabulary())
    assert len(tokens) > 48_000
    automaton = tc.Automaton(tokens)
    pick = random.Random(4)
    words = ["hello", "unbelievable", "日本語", "é", "x" * 500, "hhhello", "!", "naïve", "0123456789"]
    words += ["".join(pick.choices("etaoinshrdlu", k=pick.randrange(1, 15))) for _ in range(300)]
    for word in words:
        assert automaton.count(word) == greedy(tokens, word)


def test_documents(spark):
    tokens = [tuple(t) for t in (b"a", b"ab", b"b")] + [(*b"a", tc.END), (*b"b", tc.END), (tc.END,)]
    rows = [(None, "Ab a"), (1, None), (2, ""), (2, ""), (3, "ab! " * 50_000), (4, "éa")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, N_WORDS int")
    found = {(r.doc_id, r.text): (r.n_words, r.n_tokens) for r in tc.counted(frame, tokens).collect()}
    assert found[None, "Ab a"] == (2, 3)
    assert found[1, None] == found[2, ""] == (0, 0)
    assert found[3, "ab! " * 50_000] == (100_000, 150_000)
    assert found[4, "éa"] == (1, 1)
    assert tc.counted(frame.limit(0), tokens).count() == 0
