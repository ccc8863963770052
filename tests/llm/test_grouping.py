"""Suffix arrays of many strings, against sorting."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeferry.llm.grouping import suffix_arrays

STRING = st.lists(st.integers(1, 4), max_size=40) | st.lists(st.integers(1, 3), max_size=6).map(lambda s: s * 7)


@settings(max_examples=400, deadline=None)
@given(st.lists(STRING, max_size=7))
def test_any_strings(strings):
    strings = [[*s, 0] for s in strings]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in strings]))).astype(int)
    symbols = np.array([x for s in strings for x in s], int)
    wanted = [o + p for s, o in zip(strings, bounds) for p in sorted(range(len(s)), key=lambda p: s[p:])]
    assert suffix_arrays(symbols, bounds).tolist() == wanted
