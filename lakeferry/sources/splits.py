"""Cutting a table into key ranges, one per reader, of about equal numbers of rows.

The source makes a histogram of its keys: one ``GROUP BY`` counts them in groups
of neighbours, numbers by equal widths, texts by the characters they begin with.
Groups that hold more than a share are counted again in finer groups, all of them
in one query, until none does or what does is a single key. Running sums over the
groups then give the cuts. So what the source does for a row does not
depend on the number of ranges, and the queries of a table are bounded by the
levels of its groups.

A row belongs to the range its key lies in; a NULL key belongs to the first. Groups
of texts are put in the source's own order, whatever its collation, so each row is
read exactly once. A single key with more than its share is cut by a second column, if one
is given.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil
from numbers import Number
from os.path import commonprefix

#: Runs a query of the source and gives its rows. All of them are one row per
#: table, or per group of the histogram.
Ask = Callable[[str], Sequence[Sequence]]

#: Tables asked for in one query.
TABLES_A_QUERY = 50
#: Into how many groups of equal width a heavy one is cut; a power of two, so
#: that finer groups never cross the edges of coarser ones.
FINER = 64
#: Widths beyond which doubles can't tell neighbours apart.
FINEST = 2.0**-52


def literal(cut, backslash: bool = False) -> str:
    """A key as SQL. With ``backslash``, the source reads it as an escape."""
    if not isinstance(cut, str):
        return str(cut)
    if backslash:
        return "'" + cut.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "'" + cut.replace("'", "''") + "'"


def split_predicates(key: str, cuts: Sequence, backslash: bool = False) -> list[str]:
    """One SQL condition per reader, two bounds each; cuts stand in the order of the source."""
    if not cuts:
        return ["1=1"]
    shown = [literal(cut, backslash) for cut in cuts]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(shown, shown[1:])]
    return [f"{key} < {shown[0]} OR {key} IS NULL", *inner, f"{key} >= {shown[-1]}"]


@dataclass(frozen=True)
class Group:
    """Neighbouring keys: the first, the last, and how many rows have them."""

    low: object
    high: object
    held: int

    @property
    def single(self) -> bool:
        return self.low == self.high


def ranges(groups: Sequence[Group], share: int) -> list[list[Group]]:
    """Neighbouring groups together, as long as they hold no more than a share."""
    out: list[list[Group]] = []
    room = 0
    for group in groups:
        if group.held > room:
            out.append([])
            room = share
        out[-1].append(group)
        room -= group.held
    return out


class _Histogram:
    """The groups of one table, and what cuts its keys into finer ones."""

    def __init__(self, table: str, key: str, whole: Group, share: int):
        self.table = table
        self.key = key
        self.share = share
        self.groups = [whole]
        self.numeric = isinstance(whole.low, Number)
        if not (self.numeric or whole.single or isinstance(whole.low, str)):
            raise TypeError(f"cannot split on a key of type {type(whole.low).__name__}")
        self.low = whole.low
        self.reach = float(whole.high - whole.low) if self.numeric else 0
        #: how finely keys are grouped now: a width, or a number of characters
        self.grain: float = self.reach
        self._before: float = self.reach

    def heavy(self) -> list[Group]:
        """The groups to count again; none if there is no finer grain."""
        some = [g for g in self.groups if g.held > self.share and not g.single]
        if self.numeric:
            return some if self.grain > self.reach * FINEST else []
        return [g for g in some if max(len(g.low), len(g.high)) >= self.grain]

    def _grouped(self, grain: float) -> str:
        if self.numeric and self.reach < 2.0**62:
            return f"FLOOR(({self.key} - ({self.low}) + 0E0) / {grain!r})"
        if self.numeric:  # the difference is no whole number of 64 bits
            return f"FLOOR(({self.key} + 0E0 - ({float(self.low)!r})) / {grain!r})"
        return f"SUBSTR({self.key}, 1, {int(grain)})"

    def _keys(self, **groups: str) -> str:
        """The keys with the groups they are in, by name: some databases group by names only."""
        named = "".join(f", {value} AS {name}" for name, value in groups.items())
        return f"(SELECT {self.key} AS k{named} FROM {self.table} s WHERE {self.key} IS NOT NULL)"

    def query(self, place: int) -> str:
        """Counts the heavy groups in finer ones: place, parent, low, high, held, ahead.

        Heavy groups are found in the source once more and joined by equality,
        so the query is as long for many of them as for one. ``ahead`` is how many rows of
        the parent come before, in the source's order of texts.
        """
        heavy = self.heavy()
        first = self.grain == self.reach
        if not self.numeric:
            same = min(len(commonprefix([g.low, g.high])) for g in heavy)
            finer = max(int(self.grain), same) + 1
        elif first:
            finer = self.reach / (2 * ceil(heavy[0].held / self.share))
        else:
            finer = self.grain / FINER
        before = self._before = self.grain
        self.grain = finer
        parent = "0" if first else self._grouped(before)
        rows = f"{self._keys(p=parent, c=self._grouped(finer))} t"
        if not first:
            rows += (
                f" JOIN (SELECT p FROM {self._keys(p=parent)} u GROUP BY p"
                f" HAVING COUNT(*) > {self.share} AND MIN(k) <> MAX(k)) h ON t.p = h.p"
            )
        counts = (
            "SELECT t.p AS parent, MIN(t.k) AS low, MAX(t.k) AS high, COUNT(*) AS held"
            f" FROM {rows} GROUP BY t.p, t.c"
        )
        if self.numeric:
            return f"SELECT {place} AS place, low, high, held, 0 AS ahead FROM ({counts}) g{place}"
        return (
            f"SELECT {place} AS place, x.low AS low, x.high AS high, x.held AS held,"
            f" COALESCE(SUM(y.held), 0) AS ahead FROM ({counts}) x"
            f" LEFT JOIN ({counts}) y ON y.parent = x.parent AND y.low < x.low"
            " GROUP BY x.parent, x.low, x.high, x.held"
        )

    def refine(self, rows: Sequence[Sequence]) -> None:
        """Put finer groups in the place of heavy ones."""
        heavy = [n for n, g in enumerate(self.groups) if g.held > self.share and not g.single]
        owner = self._owners(heavy)
        finer: dict[int, list[tuple[int, Group]]] = {}
        for low, high, held, ahead in rows:
            finer.setdefault(owner(low), []).append((int(ahead), Group(low, high, int(held))))
        out: list[Group] = []
        for n, group in enumerate(self.groups):
            parts = finer.get(n, [])
            if sum(part.held for _, part in parts) != group.held:
                out.append(group)  # rows came or went, or the order is none of characters
            else:
                by = (lambda x: x[1].low) if self.numeric else (lambda x: x[0])
                out += [part for _, part in sorted(parts, key=by)]
        self.groups = out

    def _owners(self, heavy: list[int]) -> Callable[[object], int | None]:
        """Tells which of the heavy groups a finer one is part of, by its first key."""
        if len(heavy) == 1:
            return lambda low: heavy[0]
        if self.numeric:
            lows = [self.groups[n].low for n in heavy]
            return lambda low: heavy[max(bisect_right(lows, low) - 1, 0)]
        size = int(self._before)
        exact = {self.groups[n].low[:size]: n for n in heavy}
        folded = {x.casefold(): n for x, n in exact.items()}
        return lambda low: exact.get(low[:size], folded.get(low[:size].casefold()))


class Cutter:
    """Finds ranges, so that none holds over twice its share, if keys allow.

    A share is the rows by the readers, or ``range_rows`` if that is less. A key
    with more rows than that is cut by ``second``, another column, if it is given.
    """

    def __init__(
        self,
        ask: Ask,
        key: str,
        readers: int,
        range_rows: int,
        backslash: bool = False,
        second: str | None = None,
    ):
        self.ask = ask
        self.key = key
        self.readers = readers
        self.range_rows = range_rows
        self.backslash = backslash
        self.second = second

    def cuts(self, tables: Sequence[str]) -> dict[str, list]:
        """The cuts of each table, in its order of keys."""
        return {
            table: [part[0].low for part in parts[1:]] for table, (parts, _) in self._ranges(tables).items()
        }

    def conditions(self, tables: Sequence[str]) -> dict[str, list[str]]:
        """The conditions of each table's readers; each row meets one of its table's."""
        found = self._ranges(tables)
        inner = self._inside(found) if self.second else {}
        out = {}
        for table, (parts, _) in found.items():
            bounds = split_predicates(self.key, [part[0].low for part in parts[1:]], self.backslash)
            out[table] = []
            for n, bound in enumerate(bounds):
                finer = inner.get((table, n), ["1=1"])
                out[table] += [f"({bound}) AND ({x})" for x in finer] if len(finer) > 1 else [bound]
        return out

    def _inside(self, found: dict[str, tuple[list[list[Group]], int]]) -> dict[tuple, list[str]]:
        """Conditions on the second column, for ranges of a single key that hold too much."""
        asked, shares = {}, {}
        for table, (parts, share) in found.items():
            for n, part in enumerate(parts):
                if len(part) == 1 and part[0].single and part[0].held > share:
                    is_key = f"{self.key} = {literal(part[0].low, self.backslash)}"
                    rows = f"(SELECT {self.second} FROM {table} WHERE {is_key})"
                    asked[rows], shares[rows] = (table, n), share
        out = {}
        finer = Cutter(self.ask, self.second, 1, 1, self.backslash)
        for rows, cuts in finer._cuts_by(shares).items():
            out[asked[rows]] = split_predicates(self.second, cuts, self.backslash)
        return out

    def _cuts_by(self, shares: dict[str, int]) -> dict[str, list]:
        found = self._ranges(list(shares), shares)
        return {table: [part[0].low for part in parts[1:]] for table, (parts, _) in found.items()}

    def _ranges(
        self, tables: Sequence[str], shares: dict[str, int] | None = None
    ) -> dict[str, tuple[list[list[Group]], int]]:
        """Of each table its ranges, as groups of keys, and its share."""
        found: dict[str, tuple[list[list[Group]], int]] = {}
        for i in range(0, len(tables), TABLES_A_QUERY):
            some = tables[i : i + TABLES_A_QUERY]
            for one in self._histograms(some, shares):
                found[one.table] = (ranges(one.groups, one.share), one.share)
        return {table: found.get(table, ([[]], 1)) for table in tables}

    def _histograms(self, tables: Sequence[str], shares: dict[str, int] | None) -> list[_Histogram]:
        asked = [
            f"SELECT {i} AS place, COUNT({self.key}) AS held, MIN({self.key}) AS low,"
            f" MAX({self.key}) AS high FROM {table} t{i}"
            for i, table in enumerate(tables)
        ]
        out = []
        for place, held, low, high in self.ask(" UNION ALL ".join(asked)):
            table = tables[place]
            share = shares[table] if shares else min(ceil(held / self.readers), self.range_rows)
            if held > max(1, share):
                out.append(_Histogram(table, self.key, Group(low, high, int(held)), max(1, share)))
        while True:
            open_ = [one for one in out if one.heavy()]
            if not open_:
                return out
            rows: list[list] = [[] for _ in open_]
            queries = [one.query(i) for i, one in enumerate(open_)]
            for place, *row in self.ask(" UNION ALL ".join(queries)):
                rows[place].append(row)
            for one, its in zip(open_, rows, strict=True):
                one.refine(its)
