"""Benchmark decontamination by suffix arrays over the words of the training texts.

Each task cuts its documents into shards and builds a suffix array over the
words of each shard. Every suffix of every benchmark item is looked up there by
binary search: the run of equal 13-word prefixes gives all verbatim occurrences
and their locations, the neighbours of the place give the longest match. A
document's result depends on the document and the benchmark alone, so nothing
is shuffled and a hot passage costs no more than any other.

Words and items are those of the contract: see `words.py`; a window is 13
consecutive words of an item; an item of fewer, but not none, is one window. A
word inside any occurrence is hit. A document is contaminated if hit words are
at least a twentieth of its words, and at least one.

The benchmark is sent to all tasks in blocks of at most `BLOCK_BYTES` of text.
A larger one takes more passes over the documents; results are the same.

Defined results: null and empty texts have no words and are never contaminated;
null or empty items have no windows; rows of one item_id are one item; an item
without id counts under the empty id; repeated documents are judged each by
itself; an empty table gives an empty result. Other columns pass through, but for
those named like a column of `report`, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.scratch import free_name
from lakeferry.llm.words import Words, parts

WINDOW = 13
BLOCK_BYTES = 32 << 20
#: bytes of text in a shard (a longer document is a shard of its own)
SHARD_BYTES = 1 << 20


class Benchmark:
    """The words of a block of items, as numbers from 1 in the order of their hashes."""

    def __init__(self, table: pa.Table) -> None:
        words = Words(table.column("text").combine_chunks())
        self.items = ["" if x is None else str(x) for x in table.column("item").to_pylist()]
        self.vocabulary = np.unique(words.hash)
        n = len(words)
        # a separator (0) behind each item, so that no suffix runs into the next
        self.place = np.arange(n) + words.text
        self.words = np.zeros(n + words.texts + 1, np.int64)
        self.words[self.place] = np.searchsorted(self.vocabulary, words.hash) + 1
        ends = words.bounds[words.text + 1]
        self.left = ends - np.arange(n)  # words from here to the end of the item
        counts = np.diff(words.bounds)[words.text]
        starts = words.bounds[words.text] == np.arange(n)
        self.text = words.text
        self.window = np.where(self.left >= WINDOW, WINDOW, np.where(starts, counts, 0))
        self.depth = int(self.left.max(initial=1))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Of each word its number, or 0 if no item has it."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of non-zero words, ordered by the words from there to the next zero.

    Prefix doubling, each time of the groups that are still tied only; beyond
    `depth` words ties stay, as no search looks further.
    """
    n = len(words)
    at = np.flatnonzero(words)
    if not len(at):
        return at
    zeros = np.append(np.flatnonzero(words == 0), n)
    end = zeros[np.searchsorted(zeros, np.arange(n))]
    array = at[np.argsort(words[at], kind="stable")]
    rank = np.zeros(n + 1, np.int64)
    tied, key, known = np.arange(len(array)), words[array], 1
    ended = np.zeros(len(array), bool)
    while True:
        first = np.concatenate(([True], key[1:] != key[:-1]))
        begin = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        rank[array[tied]] = tied[begin][group] + 1
        many = np.diff(np.append(begin, len(tied)))[group] > 1
        tied = tied[many & ~ended]  # suffixes that end together are equal
        if known >= depth or not len(tied):
            return array
        place = array[tied]
        on = np.where(place + known < end[place], rank[np.minimum(place + known, n)], 0)
        key = rank[place] * (n + 2) + on
        order = np.argsort(key, kind="stable")
        array[tied], key, ended = place[order], key[order], on[order] == 0
        known *= 2


def _below(words, array, middle, query, place, length, or_equal):
    """Whether the suffix at `middle` is less than a query prefix (or equal to it)."""
    less = np.zeros(len(middle), bool)
    same = np.arange(len(middle))
    suffix, n = array[middle], len(words)
    step = 0
    while len(same):
        same = same[length[same] > step]
        if not len(same):
            break
        at = suffix[same] + step
        mine = np.where(at < n, words[np.minimum(at, n - 1)], 0)
        theirs = query[place[same] + step]
        less[same[mine < theirs]] = True
        same = same[(mine == theirs) & (mine > 0)]
        step += 1
        if or_equal:
            less[same[length[same] == step]] = True
    return less


def search(words, array, query, place, length, after=False):
    """Of each query prefix, how many suffixes are less (or, `after`, not greater)."""
    low = np.zeros(len(place), np.int64)
    high = np.full(len(place), len(array), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        less = _below(words, array, middle, query, place[open_], length[open_], after)
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)


class Shard:
    """Documents with their suffix array, over the words that the benchmark knows."""

    def __init__(self, column: pa.Array, benchmark: Benchmark) -> None:
        self.benchmark = benchmark
        self.found = Words(column)
        n = len(self.found)
        self.place = np.arange(n) + self.found.text
        self.words = np.zeros(n + self.found.texts + 1, np.int64)
        self.words[self.place] = benchmark.number(self.found.hash)
        self.array = suffix_array(self.words, benchmark.depth)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """The different windows that occur: their runs in the suffix array, lengths, and items.

        Runs of one length don't overlap, so all of them together have no more places
        than there are words, times the lengths that windows have.
        """
        b = self.benchmark
        some = np.flatnonzero(b.window)
        low = search(self.words, self.array, b.words, b.place[some], b.window[some])
        high = search(self.words, self.array, b.words, b.place[some], b.window[some], after=True)
        there = high > low
        low, high, some = low[there], high[there], some[there]
        # equal windows have equal runs
        runs, which = np.unique(np.stack((low, high, b.window[some])), axis=1, return_inverse=True)
        owners = np.unique(np.stack((which.reshape(-1), b.text[some])), axis=1)
        edges = np.searchsorted(owners[0], np.arange(1, runs.shape[1]))
        return runs[0], runs[1], runs[2], np.split(owners[1], edges)

    def spans(self) -> tuple[list[list[int]], list[list[str]]]:
        """Of each document the hit runs of words (start, end, ...) and the items found."""
        texts = self.found.texts
        spans: list[list[int]] = [[] for _ in range(texts)]
        items: list[list[str]] = [[] for _ in range(texts)]
        low, high, length, owners = self.windows()
        if not len(low):
            return spans, items
        count = high - low
        which = np.repeat(np.arange(len(low)), count)
        place = self.array[np.arange(len(which)) + np.repeat(low - (np.cumsum(count) - count), count)]
        change = np.bincount(place, minlength=len(self.words) + 1)
        change -= np.bincount(place + length[which], minlength=len(self.words) + 1)
        hit = np.cumsum(change) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
        offset = self.found.bounds + np.arange(texts + 1)
        for start, end in edge.reshape(-1, 2).tolist():
            text = int(np.searchsorted(offset, start, "right")) - 1
            spans[text] += [start - int(offset[text]), end - int(offset[text])]
        # windows of the same items count as one
        kinds: dict[bytes, int] = {}
        kind = np.array([kinds.setdefault(x.tobytes(), len(kinds)) for x in owners])
        rows = [np.frombuffer(x, owners[0].dtype) for x in kinds]
        names = [{self.benchmark.items[row] for row in x} for x in rows]
        owner = np.searchsorted(offset, place, "right") - 1
        for text, one in np.unique(np.stack((owner, kind[which]), 1), axis=0).tolist():
            items[text] += names[one]
        return spans, [sorted(set(x)) for x in items]

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each test suffix, its longest match here in words, and a place of it."""
        b = self.benchmark
        low = search(self.words, self.array, b.words, b.place, b.left)
        best, where = np.zeros(len(b.place), np.int64), np.full(len(b.place), -1)
        for near in (low - 1, low):
            real = (near >= 0) & (near < len(self.array))
            same = np.flatnonzero(real)
            at = np.zeros(len(best), np.int64)
            at[same] = self.array[near[same]]
            step = 0
            length = np.zeros(len(best), np.int64)
            while len(same):
                here = np.minimum(at[same] + step, len(self.words) - 1)
                equal = (self.words[here] == b.words[b.place[same] + step]) & (self.words[here] > 0)
                same = same[equal & (step < b.left[same])]
                length[same] += 1
                step += 1
            better = length > best
            best[better], where[better] = length[better], at[better]
        return best, where


def blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[pa.Table]:
    """The benchmark in tables of about `limit` bytes, each fetched when it is asked for."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // limit) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield rows.where(block == k).toArrow() if n > 1 else rows.toArrow()


def united(spans: list[int]) -> list[int]:
    """Runs (start, end, ...) without overlaps, in order."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


STATE = {"words": "word_count", "hit": "hit_count", "spans": "hit_spans", "items": "hit_items"}


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with words, hit words, their runs and items, and those columns' names."""
    context = docs.sparkSession.sparkContext
    names = {key: free_name(docs, name) for key, name in STATE.items()}
    longs, texts = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
    kinds = {"words": T.LongType(), "hit": T.LongType(), "spans": longs, "items": texts}
    schema = T.StructType([*docs.schema, *[T.StructField(names[k], kinds[k]) for k in names]])
    frame = docs.select("*", *[F.lit(None).cast(kinds[k]).alias(names[k]) for k in names])
    for table in blocks(benchmark, item, item_text, block_bytes):
        sent = context.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Benchmark(sent.value)
            for batch in batches:
                for part in parts(batch, text, SHARD_BYTES):
                    shard = Shard(part.column(text), index)
                    spans, items = shard.spans()
                    before = part.column(names["spans"]).to_pylist()
                    spans = [united((a or []) + b) for a, b in zip(before, spans, strict=True)]
                    before = part.column(names["items"]).to_pylist()
                    items = [sorted({*(a or []), *b}) for a, b in zip(before, items, strict=True)]
                    state = [
                        pa.array(np.diff(shard.found.bounds), pa.int64()),
                        pa.array([sum(x[1::2]) - sum(x[::2]) for x in spans], pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string())),
                    ]
                    columns = [*part.columns[: -len(state)], *state]
                    yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

        frame = frame.mapInArrow(run, schema)
    return frame, names


REPORT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Of each document its words, hit words, found items, and whether it is contaminated."""
    frame, names = with_hits(docs, benchmark, **options)
    n, hit = F.col(names["words"]), F.col(names["hit"])
    return frame.select(
        *[column for column in docs.columns if column.lower() not in REPORT],
        n.alias("n_words"),
        hit.alias("n_hit"),
        F.size(names["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names["items"]), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= n)).alias("contaminated"),
        F.col(names["spans"]).alias("spans"),
        F.col(names["items"]).alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    frame, names = with_hits(docs, benchmark, **options)
    n, hit = F.col(names["words"]), F.col(names["hit"])
    return frame.where((hit == 0) | (20 * hit < n)).select(*docs.columns)


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Of every suffix of every item its longest verbatim match, and where it is.

    One row per suffix that matches at all: item, number of its first word,
    length in words, and the document and word of one such match (the smallest
    document, then the first word). Shards are merged by a maximum per suffix,
    which is taken in each task first.
    """
    context = docs.sparkSession.sparkContext
    source = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    schema = "item string, item_word long, n_words long, doc string, doc_word long"
    found = None
    for table in blocks(benchmark, item, item_text, block_bytes):
        sent = context.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Benchmark(sent.value)
            first = np.searchsorted(index.text, np.arange(len(index.items)))
            for batch in batches:
                for part in parts(batch, "text", SHARD_BYTES):
                    shard = Shard(part.column("text"), index)
                    length, where = shard.longest()
                    some = np.flatnonzero(length)
                    offset = shard.found.bounds + np.arange(shard.found.texts + 1)
                    doc = np.searchsorted(offset, where[some], "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([index.items[t] for t in index.text[some]], pa.string()),
                            pa.array(some - first[index.text[some]], pa.int64()),
                            pa.array(length[some], pa.int64()),
                            part.column("doc_id").take(pa.array(doc, pa.int64())).cast(pa.string()),
                            pa.array(where[some] - offset[doc], pa.int64()),
                        ],
                        names=["item", "item_word", "n_words", "doc", "doc_word"],
                    )

        rows = source.mapInArrow(run, schema)
        found = rows if found is None else found.unionByName(rows)
    best = F.min(F.struct(-F.col("n_words"), "doc", "doc_word"))
    return (
        found.groupBy("item", "item_word")
        .agg(best.alias("best"))
        .select(
            "item", "item_word", (-F.col("best.col1")).alias("n_words"), "best.doc", "best.doc_word"
        )
    )
