"""MinHash near-duplicates of weighted word shingles, by ProbMinHash.

Each document is a set of five-word shingles, weighted 1 + ln(occurrences). A
shingle of weight w is a Poisson process of rate w: its arrivals are hashed from
the shingle, and each arrival goes to one of m components. A component keeps the
shingle that arrives first, so two documents agree in a component with the
probability Jaccard similarity of their weighted shingles (their Jaccard
similarity, where each shingle occurs once). Documents that repeat shingles are
sketched a second time with all weights 1, and have the bands of both sketches: so
any two documents have bands whose components agree with their Jaccard similarity,
however often either repeats what they share. A shingle is done as soon as its
next arrival is later than the first arrivals of all components; long documents
stop after about one arrival per shingle.

The m = 120 components make 24 bands of 5. Documents that share a band are
candidates; at a similarity of 0.8 a pair shares one with probability 0.9999.
Where most of a band's documents are linked already, the others are compared by
bins first: each of 512 bins holds four bits of its least shingle, and pairs of
a similarity of 0.8 differ in more than 0.256 of the bins that one of them uses
with a probability of 0.0001 or less. Candidates are verified exactly: linked if the Jaccard similarity of their
distinct shingles is 0.8 or more. Classes are the components of these links,
found without writing out all pairs (see `linking.py`). Documents of the same
shingles are collapsed to one before anything is compared.

Defined results: words are those of `words.py`; a document of one to four words
has one shingle of all of them. Documents without words (null and empty texts
among them; null counts as empty) are copies of each other if their texts are equal, and
near nothing else. Rows that repeat doc_id and text are one document; a null
doc_id is a doc_id like any other, and the last of a class to be kept. An empty
table gives an empty result. Other columns, whatever their names, pass through
`near_duplicates_removed`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.linking import link
from lakeferry.llm.scratch import Scratch, free_name
from lakeferry.llm.words import Words, mix, parts, powers

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
BINS = 512
#: the share of bins in which similar documents may differ: four deviations above the
#: mean at 0.8; and how many more, for documents that fill few bins
DIFFERENT, MORE = 0.256, 3
PART_BYTES, ROW_BYTES = 1 << 20, 4 << 10

_ARRIVAL = 0xA0761D6478BD642F
_PLACE = np.uint64(0xE7037ED1A0B428DB)


def sketch(
    shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, size: int
) -> np.ndarray:
    """For each text the shingle that arrives first in each component (0 if it has none).

    `owner` gives the text of each shingle; a shingle stands once in a text.
    """
    first = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, np.uint64)
    latest = np.full(texts, np.inf)
    time = np.zeros(len(shingles))
    running, turn = np.arange(len(shingles)), 0
    while len(running):
        mark = np.uint64((2 * turn + 1) * _ARRIVAL % (1 << 64))
        random = mix(shingles[running] ^ mark)
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[running] -= np.log(uniform) / weights[running]
        early = time[running] < latest[owner[running]]
        running, random = running[early], random[early]
        slot = owner[running] * size + (mix(random ^ _PLACE) % np.uint64(size)).astype(np.int64)
        wins = time[running] < first[slot]
        slot, by = slot[wins], running[wins]
        order = np.lexsort((shingles[by], time[by]))[::-1]  # the earliest is written last
        first[slot[order]] = time[by[order]]
        winner[slot[order]] = shingles[by[order]]
        touched = np.unique(owner[by])
        latest[touched] = first.reshape(texts, size)[touched].max(1)
        turn += 1
    return winner.reshape(texts, size)


def distinct_shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's shingles once, sorted by text: hash, occurrences, text."""
    hashes, texts = words.shingles(WIDTH)
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    begin = np.flatnonzero(new)
    return hashes[begin], np.diff(np.append(begin, len(hashes))), texts[begin]


def bins(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Of each text 16 bins a word: four bits of the least hash in each, 0 if it has none."""
    least = np.full(texts * BINS, np.iinfo(np.uint64).max)
    spread = mix(hashes + np.uint64(9))
    np.minimum.at(least, owner * BINS + (hashes % np.uint64(BINS)).astype(np.int64), spread)
    empty = least == np.iinfo(np.uint64).max
    four = np.where(empty, 0, mix(least) % np.uint64(15) + np.uint64(1)).astype(np.uint64)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return (four.reshape(texts, -1, 16) << shifts).sum(2, dtype=np.uint64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES, ROW_BYTES):
            words = Words(part.column("text"))
            n = words.texts
            hashes, counts, owner = distinct_shingles(words)
            bounds = np.searchsorted(owner, np.arange(n + 1))
            size = np.diff(bounds)
            # 128 bits of the set: two sums of differently mixed shingles
            low, high = (mix(_sums(mix(hashes ^ np.uint64(k)), bounds)) for k in (1, 2))
            blank = size == 0
            if blank.any():
                rows = np.flatnonzero(blank)
                texts = part.column("text").take(pa.array(rows)).to_pylist()
                raw = b"".join(hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts)
                low[rows], high[rows] = np.frombuffer(raw, np.uint64).reshape(-1, 2).T
            first = sketch(hashes, 1 + np.log(counts), owner, n, BANDS * ROWS)
            up, _ = powers(ROWS + 1)
            # where nothing is repeated, the sketch by unit weights is the same
            repeats = np.zeros(n, bool)
            repeats[owner[counts > 1]] = True
            again, place = repeats[owner], np.cumsum(repeats) - 1
            unit = sketch(
                hashes[again], np.ones(again.sum()), place[owner[again]], repeats.sum(), BANDS * ROWS
            )
            both = np.zeros((n, 2, BANDS * ROWS), np.uint64)
            both[:, 0], both[repeats, 1] = first, unit
            bands = mix((both.reshape(n, 2, BANDS, ROWS) * up[1:]).sum(3, dtype=np.uint64))
            bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64))
            bands = bands[np.stack((~blank, repeats), 1)]
            offsets = np.concatenate(([0], np.cumsum(BANDS * (repeats + 1 - blank)))).astype(np.int32)
            bits = bins(hashes, owner, n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("mark"),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    pa.array(size, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets), pa.array(bands.reshape(-1).view(np.int64))
                    ),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1) * bits.shape[1], pa.int32()),
                        pa.array(bits.reshape(-1).view(np.int64)),
                    ),
                ],
                names=["doc_id", "mark", "low", "high", "n_shingles", "bands", "bits"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES):
            hashes, _, owner = distinct_shingles(Words(part.column("text")))
            offsets = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=["id", "shingles"])


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents' ids and texts; `mark` tells apart rows of one id."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("mark"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per distinct doc_id and text: its class, and whether it is the one to keep.

    Columns: doc_id, mark (hash of the text), n_shingles, class_id (the smallest doc_id of the
    class; null if it has none), class_size (its rows here), kept (one in each
    class: the smallest doc_id, then the smallest mark).
    """
    scratch = Scratch(docs.sparkSession)
    marked = _marked(docs, doc_id, text)
    kind = marked.schema["doc_id"].dataType.simpleString()
    seen = marked.mapInArrow(
        _sketched,
        f"doc_id {kind}, mark long, low long, high long, n_shingles long,"
        " bands array<long>, bits array<long>",
    )
    seen = scratch.save(seen, "sketches")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("one")
    firsts = [F.first(c).alias(c) for c in ("bands", "bits")]
    classes = seen.groupBy("low", "high").agg(one, *firsts)
    classes = scratch.save(
        classes.withColumn("id", F.monotonically_increasing_id()), "classes"
    )
    buckets = classes.select("id", F.explode(F.array_distinct("bands")).alias("key"))

    def prepare(ids: DataFrame):
        wanted = classes.join(ids, "id").select("id", "one.doc_id", "one.mark")
        same = (F.col("w.doc_id").eqNullSafe(F.col("m.doc_id"))) & (F.col("w.mark") == F.col("m.mark"))
        texts = marked.alias("m").join(wanted.alias("w"), same).select("id", "text")
        sets = scratch.save(texts.mapInArrow(_sets, "id long, shingles array<long>"), "sets")
        sets = sets.dropDuplicates(["id"]) if _repeats(seen) else sets

        def verify(pairs: DataFrame) -> DataFrame:
            a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
            b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
            both = F.size(F.array_intersect("sa", "sb"))
            either = F.size("sa") + F.size("sb") - both
            pairs = pairs.join(a, "a").join(b, "b")
            return pairs.where(both >= threshold * either).select("a", "b")

        return verify

    detail = classes.select(
        "id",
        F.col("bands").alias("keys"),
        *[F.get("bits", F.lit(k)).alias(f"bits{k}") for k in range(BINS // 16)],
    )
    found = link(buckets, prepare, detail, _alike, scratch)
    classes = classes.select("id", "low", "high", "one").join(found, "id", "left")
    classes = classes.withColumn("component", F.coalesce("component", "id"))
    rows = seen.select("doc_id", "mark", "low", "high", "n_shingles").distinct()
    rows = rows.join(classes, ["low", "high"])
    rows = scratch.save(rows.select("doc_id", "mark", "n_shingles", "component", "one"), "members")
    best = rows.groupBy("component").agg(F.min("one").alias("best"), F.count("*").alias("class_size"))
    rows = rows.join(scratch.save(best, "best"), "component")
    scratch.keep("members", "best")
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark"))
    return rows.select(
        "doc_id", "mark", "n_shingles", F.col("best.doc_id").alias("class_id"), "class_size", kept.alias("kept")
    )


def _alike(a: str, b: str) -> Column:
    """Whether the bins of two documents differ in few enough of those they use."""
    ones = F.lit(0x1111111111111111)

    def count(x: Column) -> Column:
        """How many of 16 groups of four bits are not zero."""
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))

    different, used = F.lit(0), F.lit(0)
    for k in range(BINS // 16):
        x, y = F.col(f"{a}bits{k}"), F.col(f"{b}bits{k}")
        different = different + count(x.bitwiseXOR(y))
        used = used + count(x.bitwiseOR(y))
    return different <= used * F.lit(DIFFERENT) + MORE


def _repeats(seen: DataFrame) -> bool:
    """Whether any doc_id and text stands in several rows."""
    return not seen.groupBy("doc_id", "mark").count().where("count > 1").isEmpty()


def near_duplicates_removed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents, one of each class, with their own columns."""
    kept = near_duplicates(docs, doc_id, text, threshold).where("kept")
    names = {c: free_name(docs, c) for c in ("keep_id", "keep_mark")}
    kept = kept.select(F.col("doc_id").alias(names["keep_id"]), F.col("mark").alias(names["keep_mark"]))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    same = F.col(doc_id).eqNullSafe(F.col(names["keep_id"])) & (mark == F.col(names["keep_mark"]))
    joined = docs.join(kept, same)
    return joined.dropDuplicates(list(names.values())).select(*docs.columns)
