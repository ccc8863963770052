"""A quality classifier from trusted positives and unlabelled text (PU learning).

The model is linear over features of the whole text: its bytes, its pairs of
character classes, and measures of its words and their repetition. It is fitted to the non-negative unbiased
risk of positive-unlabelled learning,

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

by gradient steps that go back up where the second term has become negative.
Only labels of quality 1 are used, as trusted positives; labels of 0 are not
looked at, and those documents are unlabelled text like all others. The class
prior of the unlabelled text is estimated from a first classifier, positives
against unlabelled: where a text is certainly good, its odds are the ratio of
the two sample sizes over the prior.

Fitting uses at most `SAMPLE` positives and `SAMPLE` unlabelled documents, those
with the smallest hashes of doc_id (a documented bound); they are all that
reaches the driver. Scores are computed in one pass over all documents, without
a shuffle, from the text alone. Documents whose crc32(doc_id) mod 5 is 0 are
held out: neither their labels nor their texts are used to fit.

Defined results: null counts as empty; empty texts have a score like any other;
labels without doc_id or quality, and ids labelled both 1 and something else,
are no positives; without positives or unlabelled text every score is 0.5. Rows
that repeat a doc_id get the score of their own text. Extra columns pass
through, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.scratch import free_name
from lakeferry.llm.words import Words, as_bytes, parts

SAMPLE = 8192
ACCEPT = 0.3
FOLDS = 5
PART_BYTES = 1 << 20

_KIND = np.full(256, 7, np.int32)  # beyond ASCII
_KIND[:128] = 6  # symbols and controls
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A] = 0, 1, 2
_KIND[[0x20, 0x09]], _KIND[[0x0A, 0x0D]] = 3, 4
_KIND[[ord(c) for c in ".,;:'\"!?-()"]] = 5


def _distinct(hashes: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each text has."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    return np.bincount(texts[new], minlength=n)


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    data, starts = as_bytes(column)
    n, sizes = len(column), np.diff(starts)
    some = np.maximum(sizes, 1)[:, None]
    # a part has few enough texts and bytes for 32-bit numbers, but for a text that is longer than all
    owner = np.repeat(np.arange(n, dtype=np.int32 if n < 1 << 22 else np.int64), sizes)
    bytes_ = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256)
    kind = _KIND[data]
    inside = owner[1:] == owner[:-1]
    pairs = (owner[1:] * 64 + kind[:-1] * 8 + kind[1:])[inside]
    del owner, kind, inside
    pairs = np.bincount(pairs, minlength=n * 64).reshape(n, 64)
    words = Words(column)
    counts = np.diff(words.bounds)
    distinct = _distinct(words.hash, words.text, n)
    again = words.hash[1:] == words.hash[:-1]
    again = np.bincount(words.text[1:][again & (words.text[1:] == words.text[:-1])], minlength=n)
    pairs_distinct = _distinct(*words.shingles(2), n) / np.maximum(counts - 1, 1)
    again = again / np.maximum(counts, 1)
    letters = np.bincount(words.text, words.end - words.begin, minlength=n)
    measures = np.stack(
        [
            np.log1p(sizes),
            np.log1p(counts),
            letters / np.maximum(counts, 1),
            distinct / np.maximum(counts, 1),
            pairs_distinct,
            again,
            np.sqrt(again),
        ],
        1,
    )
    return np.hstack([np.sqrt(bytes_ / some), np.sqrt(pairs / some), measures]).astype(np.float32)


@dataclass
class Model:
    """Weights over standardised features; without weights, every score is 0.5."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0
    prior: float | None = None

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), 0.5)
        z = ((rows - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def negative_risk(x: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """R-(unlabelled) - prior * R-(positives), what unlabelled text alone would risk as bad; logistic loss."""
    return float(np.logaddexp(0, u @ x).mean() - prior * np.logaddexp(0, p @ x).mean())


def risk(x: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """The non-negative risk of weights x (the last one for the bias) over positives and unlabelled rows."""
    return float(prior * np.logaddexp(0, -(p @ x)).mean()) + max(0.0, negative_risk(x, p, u, prior))


def risk_step(x: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float, decay: float) -> np.ndarray:
    """What to go against: the risk's gradient, or back up that of its second term once that is negative."""
    at_p, at_u = _sigmoid(p @ x), _sigmoid(u @ x)
    negative = at_u @ u / len(u) - prior * (at_p @ p) / len(p)
    if negative_risk(x, p, u, prior) < 0:
        return -negative
    return prior * ((at_p - 1) @ p) / len(p) + negative + decay * x


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, decay: float = 1e-3) -> Model:
    """The model of least non-negative risk."""
    if not len(positive) or not len(unlabelled):
        return Model()
    both = np.vstack([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0) + 0.01
    ones = np.ones((len(both), 1))
    both = np.hstack([(both - mean) / scale, ones])
    p, u = both[: len(positive)], both[len(positive) :]

    def seen(fold: int) -> float:
        """How sure a classifier, positives against unlabelled, is of positives it hasn't seen."""
        p1, u1 = p[fold::2], u[fold::2]

        def apart(x):
            total = (_sigmoid(p1 @ x) - 1) @ p1 + _sigmoid(u1 @ x) @ u1
            return total / (len(p1) + len(u1)) + 20 * decay * np.append(x[:-1], 0)

        x = _descend(apart, p.shape[1], steps // 2, 0.05)
        return _sigmoid(p[1 - fold :: 2] @ x).mean()

    sure = (seen(0) + seen(1)) / 2 if min(len(p), len(u)) > 1 else 0.5
    prior = float(np.clip(len(p) / len(u) * (1 - sure) / sure, 0.05, 0.95))
    x = _descend(lambda x: risk_step(x, p, u, prior, decay), p.shape[1], steps, 0.05)
    return Model(mean, scale, x[:-1], float(x[-1]), prior)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of fitting."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES):
            rows = features(part.column("text"))
            width = rows.shape[1]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), width)
            yield pa.RecordBatch.from_arrays(
                [part.column("kind"), lists.cast(pa.list_(pa.float32()))], names=["kind", "features"]
            )


def trained(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """The model of these documents and labels. `sample` bounds what is fitted on."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("quality"))
    marks = marks.where(~held_out(F.col("doc_id"))).dropna()
    trusted = marks.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    trusted = trusted.where("low = 1 AND high = 1").select("doc_id")
    order = F.xxhash64("doc_id", F.lit(17))
    ids = rows.select("doc_id").distinct()
    good = ids.join(trusted, "doc_id", "left_semi").orderBy(order, "doc_id").limit(sample)
    rest = ids.join(trusted, "doc_id", "left_anti").orderBy(order, "doc_id").limit(sample)
    chosen = good.withColumn("kind", F.lit(1)).unionByName(rest.withColumn("kind", F.lit(0)))
    # at most two samples of ids, whatever the size of the corpus
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "kind").agg(F.min("text").alias("text"))
    found = texts.orderBy("doc_id").mapInArrow(_features, "kind int, features array<float>").toArrow()
    kind = found.column("kind").to_numpy()
    if not len(kind):
        return Model()
    flat = found.column("features").combine_chunks().flatten().to_numpy()
    matrix = flat.reshape(len(kind), -1)
    return fit(matrix[kind == 1], matrix[kind == 0])


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with columns score (0 to 1) and predicted (1 if good enough)."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    column = free_name(docs, "score_of_text")
    frame = docs.select(*kept, F.lit(0.0).alias(column))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text, PART_BYTES):
                score = sent.value.score(features(part.column(text)))
                columns = [*part.columns[:-1], pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    frame = frame.mapInArrow(run, frame.schema)
    return frame.select(
        *kept, F.col(column).alias("score"), (F.col(column) >= ACCEPT).cast("int").alias("predicted")
    )
