"""Suffix arrays by grouping suffixes by Lyndon prefixes, for many strings at once.

The longest Lyndon prefix of a suffix ends where the next smaller suffix begins.
In a first phase, suffixes are grouped by a prefix of it, to begin with by their
first symbol, and groups are taken in descending order. Each suffix of the group taken
has a previous smaller suffix: the nearest one to the left that is in a lower
group, found over pointers that jump over all higher ones. The prefix of that one grows by the
group's, once for each suffix that points to it, so it moves to a group of its
own above its old one. When all groups have been taken, they are those of whole Lyndon
prefixes, in order. In the second phase, the order within groups is emitted from
the smallest suffix up: whatever is placed next, the suffixes before it along
the pointers, as far as they have no place yet, are next in their groups.

No suffix is renamed or sorted again, and each is pointed from and placed once:
the work is linear. Strings are taken in step with each other, a group of each
at a time, so that numpy does the same step for all of them.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges of these starts and sizes, one after another."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(start - before, size)


class Groups:
    """The suffixes of some strings and their groups, as places in one array.

    `symbols` holds the strings one after another; each ends with a symbol that
    is less than all others of it and stands nowhere else in it.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray) -> None:
        n = len(symbols)
        self.bounds = bounds
        string = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.array = np.lexsort((symbols, string))
        self.place = np.empty(n, np.int64)
        self.place[self.array] = np.arange(n)
        new = np.ones(n, bool)
        ordered = symbols[self.array]
        new[1:] = (ordered[1:] != ordered[:-1]) | (string[self.array][1:] != string[self.array][:-1])
        begin = np.flatnonzero(new)
        self.size = np.zeros(n, np.int64)
        self.size[begin] = np.diff(np.append(begin, n))
        #: of each suffix, where its group begins
        self.group = np.empty(n, np.int64)
        self.group[self.array] = begin[np.cumsum(new) - 1]
        #: of each suffix, the one before it, later the previous smaller one; -1 for none
        self.previous = np.arange(-1, n - 1)
        self.previous[bounds[:-1]] = -1
        self._moves = np.zeros(n, bool)
        self._taken = np.zeros(n, bool)

    def find_previous(self, members: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Point each member to the nearest suffix to the left that is in a lower group."""
        open_ = np.arange(len(members))
        while len(open_):
            at = self.previous[members[open_]]
            jump = (at >= 0) & (self.group[at] >= group[open_])
            open_ = open_[jump]
            self.previous[members[open_]] = self.previous[at[jump]]
        return self.previous[members]

    def lift(self, suffixes: np.ndarray, times: np.ndarray) -> None:
        """Move suffixes to new groups above their old ones, the higher the more times."""
        old = self.group[suffixes]
        order = np.lexsort((times, old))
        suffixes, times, old = suffixes[order], times[order], old[order]
        first = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
        moved = np.diff(np.append(first, len(old)))
        starts = old[first]
        to = _ranges(starts + self.size[starts] - moved, moved)
        # whoever stands there makes room, where someone leaves
        self._moves[suffixes] = self._taken[to] = True
        leaving = self.place[suffixes]
        free = leaving[~self._taken[leaving]]
        there = self.array[to]
        out = there[~self._moves[there]]
        self._moves[suffixes] = self._taken[to] = False
        self.array[free], self.place[out] = out, free
        self.array[to], self.place[suffixes] = suffixes, to
        self.size[starts] -= moved
        new = np.ones(len(old), bool)
        new[1:] = (old[1:] != old[:-1]) | (times[1:] != times[:-1])
        begin = np.flatnonzero(new)
        self.size[to[begin]] = np.diff(np.append(begin, len(old)))
        self.group[suffixes] = to[begin][np.cumsum(new) - 1]

    def grow(self) -> None:
        """The first phase: all groups of all strings, in descending order."""
        low, end = self.bounds[:-1], self.bounds[1:].copy()
        while True:
            some = np.flatnonzero(end > low)
            if not len(some):
                return
            start = self.group[self.array[end[some] - 1]]
            size = end[some] - start
            members = self.array[_ranges(start, size)]
            smaller = self.find_previous(members, np.repeat(start, size))
            smaller = np.sort(smaller[smaller >= 0])
            if len(smaller):
                first = np.flatnonzero(np.concatenate(([True], smaller[1:] != smaller[:-1])))
                self.lift(smaller[first], np.diff(np.append(first, len(smaller))))
            end[some] = start

    def emit(self) -> np.ndarray:
        """The second phase: the suffixes of each string, in order."""
        n = len(self.array)
        out = np.full(n, -1)
        slot = np.arange(n)
        placed = np.zeros(n, bool)
        last = self.bounds[1:] - 1
        out[self.bounds[:-1]], placed[last] = last, True
        lengths = np.diff(self.bounds)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = self.bounds[:-1][order], lengths[order]
        for turn in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -turn, "left"))
            suffix = out[starts[:live] + turn]
            at = suffix - 1
            at = at[suffix > starts[:live]]
            at = at[~placed[at]]
            while len(at):
                group = self.group[at]
                out[slot[group]] = at
                slot[group] += 1
                placed[at] = True
                at = self.previous[at]
                at = at[at >= 0]
                at = at[~placed[at]]
        return out


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix array of each string, as places in `symbols`, one after another."""
    if not len(symbols):
        return np.zeros(0, np.int64)
    groups = Groups(symbols, bounds)
    groups.grow()
    return groups.emit()
