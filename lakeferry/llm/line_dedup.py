"""Line dedup: of lines that are equal, or an edit apart, only the first stays.

Lines of a whole corpus are joined by a segment-partition edit join. Two lines
within `THRESHOLD` edits (characters inserted, deleted or replaced) share one of
the threshold-plus-one even segments of the shorter line, and the longer line
holds it close to its place. Each distinct line is indexed by its segments and
probes the indexes of lines of its own length and those shorter by up to the
threshold, with the substrings that can start there. A segment's key has its
length class and number, so only equal keys meet. Candidates are verified by a
banded bit-parallel edit distance, many pairs at a time. Lines are of one class
if links lead from one to the other (see `linking.py`, which never writes out
all pairs of a key). The first line of a class, by doc_id and line number, stays;
all others go, in all documents.

Lines end at line feeds. Those shorter than `MIN_CHARS` characters have keys for
no edits, as they are a few edits apart by chance: only equal ones are of one
class. Those shorter than `EQUAL_CHARS` are too common even so, and stay. Equal
lines are collapsed to one before keys are joined, so a line that a third of all
documents share is one line.

Defined results: null and empty texts have no lines and stay as they are; rows
that repeat doc_id and text are one document, and each gets its result; documents
without doc_id come last. Texts without removals are unchanged to the byte. An
empty table gives an empty result. Extra columns pass through `lines_removed`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.linking import link
from lakeferry.llm.scratch import Scratch, free_name
from lakeferry.llm.words import mix, parts, powers

THRESHOLD = 2
#: the least lengths of lines that may be edited, and of lines that must be equal
MIN_CHARS, EQUAL_CHARS = 30, 8
PART_BYTES = 1 << 20
#: at most so many candidates (24 bytes each) are sent to all tasks; more are joined by a shuffle
BROADCAST_ROWS = 100_000
#: characters that a batch of pairs under verification may hold
VERIFY_CHARS = 4 << 20

_CODE = np.uint64(0x9E3779B97F4A7C15)


class Lines:
    """The lines of some texts, as code points. Empty texts have none."""

    def __init__(self, column: pa.Array) -> None:
        self.texts = pc.fill_null(column, "").to_pylist()
        self.pieces = [text.split("\n") if text else [] for text in self.texts]
        self.codes = np.frombuffer("".join(self.texts).encode("utf-32-le", "replace"), np.uint32)
        counts = np.fromiter(map(len, self.pieces), np.int64, len(self.pieces))
        self.size = np.fromiter(
            (len(line) for lines in self.pieces for line in lines), np.int64, int(counts.sum())
        )
        self.text = np.repeat(np.arange(len(counts)), counts)
        # a feed behind each line, but not behind the last one of a text
        before = np.cumsum(counts > 0) - 1
        self.begin = np.cumsum(self.size + 1) - (self.size + 1) - before[self.text]
        self.number = np.arange(len(self.size)) - (np.cumsum(counts) - counts)[self.text]

    def marks(self, chosen: np.ndarray) -> np.ndarray:
        """Two numbers for each of the chosen lines, which are equal for equal lines only."""
        of, number = self.text[chosen].tolist(), self.number[chosen].tolist()
        lines = (self.pieces[t][n].encode("utf-8", "surrogatepass") for t, n in zip(of, number, strict=True))
        raw = b"".join(hashlib.md5(line, usedforsecurity=False).digest() for line in lines)
        return np.frombuffer(raw, np.int64).reshape(-1, 2).T

    def hashes(self) -> np.ndarray:
        """Prefix sums, as those of `words.prefix_hashes`: for keys of segments, whose pairs are verified."""
        up, _ = powers(len(self.codes) + 1)
        values = mix(self.codes.astype(np.uint64) * _CODE + np.uint64(1)) | np.uint64(1)
        sums = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(values * up[: len(self.codes)], out=sums[1:])
        return sums


def places(threshold: int) -> Iterator[tuple[int, int, int]]:
    """(shorter, segment, offset) of each substring that a line has a key for.

    The segments are those of a line shorter by so many characters. A segment
    that survives in the longer line, with fewer edits before it than segments,
    and no more in all than the threshold, starts within these offsets of its
    own place. (0, segment, 0) are the line's own segments, its index.
    """
    for shorter in range(threshold + 1):
        for i in range(threshold + 1):
            low = max(-i, shorter - threshold + i)
            high = min(i, shorter + threshold - i)
            for offset in range(low, high + 1):
                yield shorter, i, offset


def keys(begin: np.ndarray, size: np.ndarray, sums: np.ndarray, threshold: int) -> np.ndarray:
    """A row of keys for each line, by the places above."""
    _, down = powers(len(sums))
    n, columns = threshold + 1, []
    for shorter, i, offset in places(threshold):
        length = size - shorter
        least, more = length // n, length % n  # the last segments are longer by one
        width = least + (i >= n - more)
        start = begin + i * least + np.maximum(i - (n - more), 0) + offset
        part = (sums[start + width] - sums[start]) * down[start]
        columns.append(mix(part ^ mix((length * n + i + 1).astype(np.uint64))))
    return np.stack(columns, 1)


def parities(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits for each line: whether it holds an odd number of each kind of character.

    An edit changes two bits at most.
    """
    line = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    kind = (codes[place] & 63).astype(np.int64)
    odd = np.bincount(line * 64 + kind, minlength=len(size) * 64).reshape(-1, 64) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64).reshape(-1)


def _indexed(threshold: int, min_chars: int, equal_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                lines = Lines(part.column("text"))
                long_ = np.flatnonzero(lines.size >= min(min_chars, equal_chars))
                begin, size = lines.begin[long_], lines.size[long_]
                sums = lines.hashes()
                low, high = lines.marks(long_)
                near = size >= min_chars
                own = keys(begin[near], size[near], sums, threshold)
                offsets = np.concatenate(([0], np.cumsum(np.where(near, own.shape[1], 0))))
                take = pa.array(lines.text[long_])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(take),
                        part.column("mark").take(take),
                        pa.array(lines.number[long_], pa.int32()),
                        pa.array(low),
                        pa.array(high),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()),
                            pa.array(own.reshape(-1).view(np.int64)),
                        ),
                        pa.array(parities(lines.codes, begin, size)),
                    ],
                    names=["doc_id", "mark", "line", "low", "high", "keys", "odd"],
                )

    return run


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    return codes, np.cumsum(sizes) - sizes, sizes


def within(first: list[str], second: list[str], threshold: int) -> np.ndarray:
    """Whether the texts of each pair are at most `threshold` edits apart.

    Bit-parallel edit distance in a band: a word holds the vertical differences
    of the 2 * threshold + 1 cells around the diagonal of a pair, its lowest row
    in the highest bit, and takes one character of the shorter text at a time.
    All pairs take a step together; those that cannot end within the threshold
    leave.
    """
    if not 0 < threshold < 31:
        raise ValueError("the band must fit into a word")
    swap = [len(a) < len(b) for a, b in zip(first, second, strict=True)]
    a, b = (
        [y if s else x for x, y, s in zip(*pair, swap, strict=True)]
        for pair in ((first, second), (second, first))
    )
    (ca, at, la), (cb, to, lb) = _codes(a), _codes(b)
    k, one = threshold, np.uint64(1)
    full = np.uint64((1 << (2 * k + 1)) - 1)
    near = la - lb <= k
    result = near & (la <= k)  # so short that no alignment costs more
    live = np.flatnonzero(near & (la > k))
    plus = np.full(len(live), int(full) >> k << k, np.uint64)
    minus = np.zeros(len(live), np.uint64)
    cost = np.full(len(live), k)
    j = 0
    while len(live):
        ended = lb[live] <= j
        result[live[ended]] = cost[ended] <= k
        # what is still to come can take back at most the band's width
        stay = ~ended & (cost <= 2 * k + lb[live] - la[live])
        live, plus, minus, cost = live[stay], plus[stay], minus[stay], cost[stay]
        if not len(live):
            break
        here, match = cb[to[live] + j], np.zeros(len(live), np.uint64)
        for r in range(2 * k + 1):
            i = j - k + r
            if i >= 0:
                real = i < la[live]
                same = real & (ca[np.where(real, at[live] + i, 0)] == here)
                match |= same.astype(np.uint64) << np.uint64(r)
        down = ((((match & plus) + plus) ^ plus) | match | minus) & full
        across_plus = minus | (~(down | plus) & full)
        across_minus = down & plus
        # on the lowest diagonal until the last row is reached, then along that row
        late = np.maximum(j - (la[live] - k) + 1, 0)
        bit = (2 * k - late).astype(np.uint64)
        on_diagonal = 1 - ((down >> bit) & one).astype(np.int64)
        along = ((across_plus >> bit) & one).astype(np.int64)
        along -= ((across_minus >> bit) & one).astype(np.int64)
        cost = cost + np.where(late > 0, along, on_diagonal)
        plus = (across_minus | ~((down >> one) | across_plus)) & full
        minus = (down >> one) & across_plus
        j += 1
    return result


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines (id and number) of each document."""
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES):
            ids, texts = [], []
            for text, wanted in zip(*(part.column(c).to_pylist() for c in ("text", "wanted")), strict=True):
                lines = text.split("\n")
                for one in wanted:
                    ids.append(one["id"])
                    texts.append(lines[one["line"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"]
            )


def _verified(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "ta", PART_BYTES):
                ta, tb = (part.column(c).to_pylist() for c in ("ta", "tb"))
                close = pa.array(within(ta, tb, threshold))
                yield part.select(["a", "b"]).filter(close)

    return run


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("mark"))


def _same(left: str, right: str):
    ids = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    return ids & (F.col(f"{left}.mark") == F.col(f"{right}.mark"))


def repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    equal_chars: int = EQUAL_CHARS,
) -> DataFrame:
    """The lines that are not the first of their class, and where that one is.

    Columns: doc_id, mark (hash of the text), line (number from 0), and first, a
    struct of doc_id, mark and line.
    """
    if min_chars < 2 * (threshold + 1) ** 2:
        raise ValueError("lines this short have no segments to go by")
    scratch = Scratch(docs.sparkSession)
    marked = _marked(docs, doc_id, text)
    kind = marked.schema["doc_id"].dataType.simpleString()
    lines = marked.mapInArrow(
        _indexed(threshold, min_chars, equal_chars),
        f"doc_id {kind}, mark long, line int, low long, high long, keys array<long>, odd long",
    )
    lines = scratch.save(lines, "lines")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "line"))
    classes = lines.groupBy("low", "high").agg(
        first.alias("first"),
        F.count("*").alias("n"),
        F.first(F.array_distinct("keys")).alias("keys"),
        F.first("odd").alias("odd"),
    )
    classes = scratch.save(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("id", F.explode("keys").alias("key"))

    def prepare(ids: DataFrame):
        wanted = classes.join(ids, "id").select("first.doc_id", "first.mark", "first.line", "id")
        wanted = scratch.save(wanted, "wanted")
        small = wanted.count() <= BROADCAST_ROWS
        wanted = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("line", "id")).alias("wanted"))
        wanted = (F.broadcast(wanted) if small else wanted).alias("w")
        texts = marked.alias("m").join(wanted, _same("m", "w")).select("text", "wanted")
        texts = texts.mapInArrow(_texts, "id long, text string").dropDuplicates(["id"])
        texts = scratch.save(texts, "texts")

        def verify(pairs: DataFrame) -> DataFrame:
            a = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
            b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
            pairs = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
            return pairs.mapInArrow(_verified(threshold), "a long, b long")

        return verify

    def close(a: str, b: str) -> Column:
        return F.bit_count(F.col(f"{a}odd").bitwiseXOR(F.col(f"{b}odd"))) <= 2 * threshold

    found = link(buckets, prepare, classes.select("id", "keys", "odd"), close, scratch)
    classes = classes.select("id", "low", "high", "first", "n").join(found, "id", "left")
    classes = classes.withColumn("component", F.coalesce("component", "id"))
    groups = classes.groupBy("component").agg(F.min("first").alias("head"), F.sum("n").alias("lines"))
    groups = scratch.save(groups.where("lines > 1"), "groups")
    classes = classes.join(groups, "component").select(
        F.col("low").alias("l"), F.col("high").alias("h"), F.col("head").alias("first")
    )
    rows = lines.select("doc_id", "mark", "line", "low", "high")
    rows = rows.join(classes, (F.col("low") == F.col("l")) & (F.col("high") == F.col("h")))
    mine = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    rows = rows.where(~(mine & (F.col("line") == F.col("first.line"))))
    rows = scratch.save(rows.select("doc_id", "mark", "line", "first"), "repeated")
    scratch.keep("repeated")
    return rows


def _without(text: str, count: str):
    """Drop the lines numbered in the last column from the text, and count them and those of use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            place = names.index(text)
            for part in parts(batch, text, PART_BYTES):
                texts, gone = part.column(text).to_pylist(), part.column(count).to_pylist()
                for row, numbers in enumerate(gone):
                    if numbers:
                        drop = set(numbers)
                        lines = texts[row].split("\n")
                        texts[row] = "\n".join(x for n, x in enumerate(lines) if n not in drop)
                columns = list(part.columns)
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def lines_removed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    removed: str | None = None,
    equal_chars: int = EQUAL_CHARS,
) -> DataFrame:
    """The documents without repeated lines; `removed` may name a column for their numbers."""
    found = repeated_lines(docs, doc_id, text, threshold, min_chars, equal_chars)
    names = [free_name(docs, c) for c in ("gone_id", "gone_mark", "gone_lines")]
    gone = found.groupBy(F.col("doc_id").alias(names[0]), F.col("mark").alias(names[1]))
    gone = gone.agg(F.sort_array(F.collect_set("line")).alias(names[2]))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    same = F.col(doc_id).eqNullSafe(F.col(names[0])) & (mark == F.col(names[1]))
    joined = docs.join(gone, same, "left").select(*docs.columns, names[2])
    kept = joined.mapInArrow(_without(text, names[2]), joined.schema)
    if removed is None:
        return kept.select(*docs.columns)
    return kept.withColumn(removed, F.coalesce(names[2], F.array().cast("array<int>"))).drop(names[2])
