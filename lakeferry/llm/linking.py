"""Classes of linked rows: candidates from buckets, links verified, components.

A bucket is a key that several ids share. Its pairs are all candidates, but they
are not all written out: the work is done in three steps, which together leave the
components what all pairs would give.

1. Every id of a bucket is compared with the bucket's smallest and largest id.
   That is two pairs a row, however large the bucket.
2. Components of the links so far. Two ids of one bucket that are in one
   component already need no comparison, and a bucket of one component none at all.
   Of a bucket of several, the smallest id of each component is compared with that of the
   component that has most ids there: again at most a pair a row.
3. In buckets that still have several components, each id outside the one with most ids
   meets those of other components, in a join whose condition leaves out
   what cannot be linked; the rest is verified. A few ids beside a large component
   cost their number times the bucket, not its square.

Sums by key are written before they are joined, so that joins on hot keys stand
alone in their stage and adaptive execution can split them; groups are reduced
to a few columns in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch

Verify = Callable[[DataFrame], DataFrame]


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u: nothing is left to join then."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.agg(F.count_if(F.col("up") + F.col("down") * F.signum("up") > 1)).first()[0] == 0


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(id, component) of every id that is linked to a smaller one of its component.

    `edges` has columns a and b; a component goes by its smallest id, which is
    not listed itself. Large-star and small-star rounds, until all that is left are
    stars around their smallest id; edges that are such stars take no round.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    name = f"{tag}_0"
    now, turn = scratch.save(now.where("u <> v").distinct(), name), 0
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # sums are written before they are joined, so that the join can split a hot vertex
        least = scratch.save(least, f"{tag}_{turn}m")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn += 1
        large = scratch.save(large.distinct(), f"{tag}_{turn}l")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = scratch.save(small, f"{tag}_{turn}")
        scratch.drop(name, f"{tag}_{turn}l", f"{tag}_{turn - 1}m")
        name = f"{tag}_{turn}"
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def link(
    buckets: DataFrame,
    prepare: Callable[[DataFrame], Verify],
    detail: DataFrame,
    close: Callable[[str, str], Column],
    scratch: Scratch,
) -> DataFrame:
    """(id, component) as of `components`, of the links among candidates.

    `buckets` has columns key and id, an id once per key at most. `prepare` gets
    the ids (column id) that have any candidate and returns the check of pairs
    (a, b), which keeps those that are linked. `detail` has a row for each id: id,
    keys (an array of its keys), and what `close` needs. `close(x, y)` is a cheap
    condition that linked ids meet, on the columns of `detail` behind prefixes x
    and y; it spares writing out what cannot be linked.
    """
    ends = buckets.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    # written first, so that the join below it can split hot keys
    ends = scratch.save(ends.where("low < high"), "ends")
    shared = scratch.save(buckets.join(ends, "key"), "shared")
    verify = prepare(shared.select("id").distinct())

    stars = shared.select("id", F.explode(F.array("low", "high")).alias("end")).where("id <> end")
    stars = stars.select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b"))
    stars = scratch.save(stars.distinct(), "stars")
    links = scratch.save(verify(stars), "links")
    found = components(links, scratch, "first")

    # the smallest id of each component of a bucket, against that of its largest
    rows, heads = _mixed(shared, found, scratch, "first")
    if heads is None:
        return found
    star = heads.where("NOT large").join(heads.where("large").select("key", F.col("head").alias("end")), "key")
    star = star.select(F.least("head", "end").alias("a"), F.greatest("head", "end").alias("b")).distinct()
    star = scratch.save(star.join(stars, ["a", "b"], "left_anti"), "heads")
    more = scratch.save(verify(star), "head_links")
    if not more.isEmpty():
        stars = stars.unionByName(star)
        found = _with(found, more, scratch, "second")
        rows, heads = _mixed(shared, found, scratch, "second")
        if heads is None:
            return found

    large = heads.where("large").select("key", F.col("component").alias("most"))
    rows = rows.join(scratch.save(large, "large"), "key").withColumn("few", F.col("component") != F.col("most"))
    rows = scratch.save(rows.drop("most").join(detail, "id"), "mixed")
    a, b = (
        rows.select(*[F.col(c).alias(c if c == "key" else f"{side}_{c}") for c in rows.columns])
        for side in "ab"
    )
    apart = F.col("a_component") != F.col("b_component")
    either = ~F.col("b_few") | (F.col("a_id") < F.col("b_id"))
    # a pair of several keys counts under the smallest of them; whether its ids are few there doesn't matter
    once = F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("key")
    pairs = a.where("a_few").join(b, "key").where(apart & either & close("a_", "b_") & once)
    pairs = pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))
    more = scratch.save(verify(pairs.join(stars, ["a", "b"], "left_anti")), "more")
    if more.isEmpty():
        return found
    return _with(found, more, scratch, "last")


def _with(found: DataFrame, links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """The components with further links: they are stars already, so few rounds are left."""
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(links), scratch, tag)


def _mixed(
    shared: DataFrame, found: DataFrame, scratch: Scratch, tag: str
) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows (key, id, component) of buckets of several components, and what these have in common.

    The latter has a row for each component of a bucket: its smallest id there (head), and
    whether it is the one with most ids there (large). Both are None without such buckets.
    """
    rows = shared.select("key", "id").join(found, "id", "left")
    rows = scratch.save(rows.withColumn("component", F.coalesce("component", "id")), f"{tag}_rows")
    sizes = rows.groupBy("key", "component").agg(F.count("*").alias("n"), F.min("id").alias("head"))
    sizes = scratch.save(sizes, f"{tag}_sizes")
    most = F.max(F.struct("n", "component"))
    keys = sizes.groupBy("key").agg(F.count("*").alias("several"), most["component"].alias("most"))
    keys = scratch.save(keys.where("several > 1").select("key", "most"), f"{tag}_keys")
    if keys.isEmpty():
        return None, None
    heads = sizes.join(keys, "key").select(
        "key", "component", "head", (F.col("component") == F.col("most")).alias("large")
    )
    return rows.join(keys.select("key"), "key"), scratch.save(heads, f"{tag}_heads")
