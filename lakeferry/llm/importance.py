"""Importance resampling towards a target distribution, by bucketed word features.

Features are runs of 1 to `longest` consecutive words (see `words.py`), joined
by one space, repeats counted; a feature's bucket is the CRC-32 of its bytes modulo
`BUCKETS`. With S features in all documents and s in a bucket, T and t in the target's
texts, the gain of a bucket is

    floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))).

A document's weight is the floored mean of the gains of its features, 0 without any;
its score adds floor(-1000 * ln(-ln(u))), u from the SHA-256 of seed and doc_id,
so that the highest scores are a draw without replacement by exp(weight / 1000).

1. Features are counted in an array of buckets in each task, and the arrays'
   sums are two arrays of `BUCKETS` numbers, whatever the size of the corpus.
   One more pass scores each document from the array of gains.
2. Scores are written with doc_id, a hash of the text and a number of the row,
   which together order all rows. The cutoff is found in one of these columns
   after another by bisection of its values: each job counts the rows at or below
   the middles of the next four halvings, exactly. So exactly the wanted number
   of rows is drawn, without sorting the rest.
3. The drawn rows alone are dealt to ranges of the order, sorted there and numbered.

Defined results: null and empty texts have no features; a null doc_id counts as
empty in the hash and comes behind all others among ties; ties go to the smaller
doc_id, then to the smaller hash of the text, then to either of two equal rows;
rows that repeat a doc_id are documents of their own. An empty table gives an
empty result, an empty target gains from its totals of 0. Columns named like a
result are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.ranks import numbered
from lakeferry.llm.scratch import Scratch, free_name
from lakeferry.llm.words import LOWER, as_bytes, crc32s, parts, word_places

BUCKETS = 10_000
LONGEST = 1
SEED = "2024"
PERCENT = 10
LEAST = 20
PART_BYTES = 1 << 20
#: halvings of an interval that one job counts for
HALVINGS = 4
RESULT = ("n_features", "weight", "score", "rank")


def feature_buckets(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each feature of some texts, and the text it is in."""
    data, starts = as_bytes(column)
    data = LOWER[data]
    begin, end = word_places(data, starts)
    text = np.searchsorted(starts, begin, "right") - 1
    if longest > 1:  # words one space apart, so that runs are slices
        size = end - begin + 1
        to = np.cumsum(size) - size
        spaced = np.full(int(size.sum()), 0x20, np.uint8)
        row = np.repeat(np.arange(len(size)), size - 1)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1)
        spaced[to[row] + inside] = data[begin[row] + inside]
        data, begin, end = spaced, to, to + size - 1
    found, owners = [], []
    for k in range(1, longest + 1):
        first = np.arange(max(len(begin) - k + 1, 0))
        first = first[text[first] == text[first + k - 1]]
        found.append(crc32s(data, begin[first], end[first + k - 1]).astype(np.int64) % buckets)
        owners.append(text[first])
    return np.concatenate(found), np.concatenate(owners)


def bucket_counts(texts: DataFrame, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features all texts have in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                found, _ = feature_buckets(part.column("text"), longest, buckets)
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    # at most a row for each bucket
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths."""
    n, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_raw + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gains: np.ndarray, text: str = "text", longest: int = LONGEST) -> DataFrame:
    """The documents with n_features and weight."""
    kept = [c for c in docs.columns if c.lower() not in ("n_features", "weight")]
    zero = F.lit(0).cast("long")
    frame = docs.select(*kept, zero.alias("n_features"), zero.alias("weight"))
    sent = docs.sparkSession.sparkContext.broadcast(gains)  # an array of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text, PART_BYTES):
                found, owner = feature_buckets(part.column(text), longest, len(sent.value))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, owner, sent.value[found])
                columns = [*part.columns[:-2], pa.array(n), pa.array(total // np.maximum(n, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return frame.mapInArrow(run, frame.schema)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by seed and doc_id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def _middles(low: int, high: int, turns: int) -> list[int]:
    """The values that the next halvings of low..high may ask for."""
    if low >= high or not turns:
        return []
    middle = (low + high) // 2
    return [*_middles(low, middle, turns - 1), middle, *_middles(middle + 1, high, turns - 1)]


def least_reaching(rows: DataFrame, key: str, wanted: int) -> tuple[int, int, int]:
    """The least value with at least `wanted` rows at or below it, and the rows below it and at it.

    There must be as many rows. Nothing but counts reaches the driver.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        cuts = _middles(low, high, HALVINGS)
        counts = rows.agg(*[F.count_if(F.col(key) <= F.lit(c)) for c in cuts]).first()
        for cut, count in zip(cuts, counts, strict=True):
            if count < wanted:
                low = max(low, cut + 1)
            else:
                high = min(high, cut)
    below, at = rows.agg(F.count_if(F.col(key) < F.lit(low)), F.count_if(F.col(key) == F.lit(low))).first()
    return low, below, at


def first_rows(rows: DataFrame, keys: Sequence[str], wanted: int) -> Column:
    """The condition that holds for exactly the first `wanted` rows in the order of the keys.

    Keys are integers and together tell all rows apart, and there are at least so many rows.
    """
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        if not wanted:
            break
        value, below, at = least_reaching(rows.where(tied), key, wanted)
        wanted -= below
        if wanted == at:
            return chosen | (tied & (F.col(key) <= F.lit(value)))
        chosen = chosen | (tied & (F.col(key) < F.lit(value)))
        tied = tied & (F.col(key) == F.lit(value))
    return chosen


def resampled(
    docs: DataFrame,
    target: DataFrame,
    carry: Sequence[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least: int = LEAST,
    seed: str = SEED,
) -> DataFrame:
    """The carried columns of every document, n_features, weight, score and rank.

    `percent` of the documents with at least `least` words are drawn; rank counts
    from 1 from the highest score, and is null for all others.
    """
    scratch = Scratch(docs.sparkSession)
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in RESULT]
    gains = bucket_gains(
        bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets)
    )
    own = ("weighed_none", "weighed_id", "weighed_mark", "weighed_row", "weighed_text", "weighed_enough")
    none, number, mark, row, whole, enough = (free_name(docs, c) for c in own)
    rows = docs.select(
        *carry,
        F.col(doc_id).isNull().cast("int").alias(none),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias(number),
        noise(F.col(doc_id), seed).alias("score"),
        F.col(text).alias(whole),
    )
    rows = weighted(rows, gains, whole, longest)
    # a text of n words has n + (n - 1) + ... features
    words_needed = sum(max(least - k, 0) for k in range(longest))
    rows = rows.select(
        *carry,
        none,
        number,
        F.xxhash64(F.coalesce(whole, F.lit(""))).alias(mark),
        "n_features",
        "weight",
        (F.col("weight") + F.col("score")).alias("score"),
        (F.col("n_features") >= words_needed).alias(enough),
        F.monotonically_increasing_id().alias(row),
    )
    rows = scratch.save(rows, "scores")
    down = free_name(rows, "down")
    able = rows.where(enough).withColumn(down, -F.col("score"))
    keys = [down, none, number, mark, row]
    wanted = able.count() * percent // 100
    drawn = first_rows(able, keys, wanted) if wanted else F.lit(False)
    rows = rows.withColumn(down, -F.col("score"))
    drawn = F.col(enough) & drawn
    result = [*carry, "n_features", "weight", "score"]
    ranked = numbered(rows.where(drawn), [F.col(c) for c in keys], "rank", scratch, "drawn")
    ranked = ranked.select(*result, (F.col("rank") + 1).alias("rank"))
    rest = rows.where(~drawn).select(*result, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
