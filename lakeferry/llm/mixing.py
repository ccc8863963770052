"""Mixing sources to target weights, as a curriculum that changes over time.

Each source has a weight schedule over training time 0 to 1, linear between
knots. Its integral is the source's weight, and the shares of all words (150 %
of what there is) follow the weights; a target stops at twice its source's
size, and the excess is shared again by weight until none is above.

Within a source, documents stand in the order of a hash, and take its target
word by word: first each document once, then a second time. The share of the
target that lies before a document is its cumulative demand; the time at which
the schedule's integral reaches that share is its training position. `mixed`
sorts the copies by position, in ranges.

All of it is DataFrame operations. The order of a source is cut into buckets of
about `BUCKET_ROWS` rows by ranges of the hash, so that running sums need no
task that holds a source: sums within buckets, over bucket totals, and over
sources are added up. What is ordered in one task is a row per source, or a row
per bucket of a source.

Defined results: the size of a null text is 0; a document of size 0 takes
nothing and has no position; null is a source of its own, the last one; rows
that repeat a doc_id, or have none, are documents of their own, as the order is that of a hash of
doc_id and text; equal rows stand next to each other, in any order. An empty table gives an empty result.
Columns named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch

Schedule = Sequence[tuple[float, float]]

SHARE = 1.5
MOST = 2
BUCKET_ROWS = 4096
#: of the sources in order, repeating: (time, weight) knots; they integrate to 3, 1 and 2
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 2.0), (1.0, 4.0)),
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)),
)
RESULT = ("size", "source_size", "target", "taken", "position")


def integral(schedule: Schedule) -> float:
    """The area under a schedule, from its first knot to its last."""
    pairs = zip(schedule, schedule[1:])
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in pairs)


def inverse(schedule: Schedule, share: Column) -> Column:
    """The time by which a schedule has covered a share (0 to 1) of its integral."""
    reached = share * integral(schedule)
    time, before = None, integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(zip(schedule, schedule[1:]))):
        before -= (t1 - t0) * (w0 + w1) / 2
        rest = F.greatest(reached - F.lit(before), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0)))
        here = F.when(rest > 0, F.lit(t0) + rest * 2 / (root + w0)).otherwise(F.lit(t0))
        here = F.least(here, F.lit(t1))
        until = before + (t1 - t0) * (w0 + w1) / 2
        time = here if time is None else F.when(reached < until, here).otherwise(time)
    return time


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(totals: DataFrame, schedules: Sequence[Schedule], share: float = SHARE) -> DataFrame:
    """Of each source (source, source_size, ...) its place in the cycle and its target."""
    everyone = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(integral(s))) for s in schedules])
    totals = (
        totals.withColumn("cycle", place % len(schedules))
        .withColumn("weight", F.get(weights, F.col("cycle")))
        .withColumn("words", F.sum("source_size").over(everyone) * F.lit(float(share)))
        .withColumn("weights", F.sum("weight").over(everyone))
    )
    # from the source that reaches its limit first: what is left for it and those after it
    before = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    limit = MOST * F.col("source_size")
    words = F.col("words") - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    totals = totals.withColumn("full", limit * weight <= words * F.col("weight"))
    taken = F.sum(F.when(F.col("full"), limit).otherwise(0)).over(everyone)
    open_words = F.first("words").over(everyone) - taken
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everyone)
    reached = F.try_divide(F.col("weight") * open_words, open_weight)
    target = F.when(F.col("full"), limit.cast("double")).otherwise(reached)
    return totals.withColumn("target", target).drop("weight", "words", "weights", "full")


def planned(
    docs: DataFrame,
    carry: Sequence[str] | None = None,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The carried columns of each document and what the mix takes of it.

    Besides the results: `copies`, an array of (copy, taken, position), one for
    each time the mix takes words of the document.
    """
    carry = docs.columns if carry is None else list(carry)
    # of the text too, so that documents that share a doc_id, or have none, are spread
    named = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"))
    mark = F.md5(F.concat(named, F.md5(F.coalesce(F.col(text), F.lit("")))))
    rows = docs.select(
        F.struct(*[c for c in carry if c.lower() not in (*RESULT, "copies")]).alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        mark.alias("mark"),
        (F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") / 2**32).alias("rank"),
    )
    # read three times, so words are counted twice only: here, and for the rows themselves
    sizes = Scratch(docs.sparkSession).save(rows.select("source", "size", "rank"), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = targets(totals, schedules, share).withColumn(
        "buckets", F.ceil(F.col("n") / BUCKET_ROWS)
    )

    def placed(frame: DataFrame) -> DataFrame:
        named = totals.withColumnRenamed("source", "of")
        joined = frame.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of", "n")
        return joined.withColumn("bucket", F.floor(F.col("rank") * F.col("buckets")))

    sums = placed(sizes).groupBy("source", "bucket")
    sums = sums.agg(F.sum("size").alias("in_bucket"))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("of"),
        F.col("bucket").alias("at"),
        F.coalesce(F.sum("in_bucket").over(order), F.lit(0)).alias("before"),
    )
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("mark")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = placed(rows).withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
    rows = rows.join(sums, same).withColumn("start", F.col("before") + F.col("inside"))

    whole = F.round("target").cast("long")

    def copy(k: int) -> Column:
        start = F.col("start") + k * F.col("source_size")
        taken = F.greatest(F.lit(0), F.least(F.col("size"), whole - start))
        share_of = F.try_divide(start + taken / 2, whole)
        position = None
        for n, schedule in enumerate(schedules):
            time = inverse(schedule, share_of)
            position = time if position is None else F.when(F.col("cycle") == n, time).otherwise(position)
        return F.struct(
            F.lit(k).alias("copy"), taken.alias("taken"), position.alias("position")
        )

    copies = F.filter(F.array(*[copy(k) for k in range(MOST)]), lambda c: c["taken"] > 0)
    rows = rows.withColumn("copies", copies)
    added = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["taken"])
    return rows.select(
        "row.*",
        "size",
        "source_size",
        "target",
        added.alias("taken"),
        F.get("copies", F.lit(0))["position"].alias("position"),
        "copies",
    )


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The training order: one row per copy, sorted by position.

    Adds copy, taken and position to the documents' columns. A copy that the
    mix takes only part of has its first words as text.
    """
    rows = planned(docs, text=text, **options)
    kept = [c for c in rows.columns if c.lower() not in (*RESULT, "copies", "copy")]
    copies = rows.select(*kept, "size", F.explode("copies").alias("c"))
    parts = F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")
    cut = F.array_join(F.slice(parts, 1, F.col("c.taken").cast("int")), " ")
    whole = F.when(F.col("c.taken") < F.col("size"), cut).otherwise(F.col(text)).alias(text)
    copies = copies.select(
        *[whole if c == text else c for c in kept],
        "c.copy",
        "c.taken",
        "c.position",
    )
    return copies.repartitionByRange("position").sortWithinPartitions("position")
