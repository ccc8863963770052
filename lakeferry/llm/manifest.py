"""A Merkle manifest of a data set: a digest per document, source and table, with proofs.

A leaf is the digest of a row's fields. Per source, leaves stand in the order of
doc_id; runs of `ARITY` nodes become their digest, level by level, until one is left,
the source's subroot. Subroots, in the order of the sources, give the root likewise.

1. Where a leaf stands is not found by sorting. The doc_ids of a source make a
   compressed bitmap: 64 ids a word, and up to 64 words, those that have bits only,
   a container, with a directory of the popcounts before each word. Words are
   merged by OR, with no more than a word and a count per task and group.
   Containers are summed up in a tree of at most 4096 children a node, so no task
   holds a source's containers. A leaf's coordinate is its rank: the ids in all
   containers before, in the words before, and in the bits before its own.
2. Leaves are keyed by coordinate into slot arrays: an array holds 27 slots, three
   levels of runs of three, and is reduced in one task. So each shuffle
   takes three levels off, and what goes on is a row per array.
3. Proofs come back the same way: each array adds its siblings to the path of the array
   above it. Only the last arrays hold documents; nothing else is of their number.

A bitmap can't tell rows that repeat a doc_id. Words that count more rows than bits are
taken out and their rows ordered by doc_id and leaf, in windows cut by digits of the leaf.

Defined results: null fields are `-` in a leaf; a null doc_id comes before all
others of its source, and null before all other sources; rows that repeat a doc_id
stand in the order of their leaves; equal rows stand next to each other, each
with its own proof. A table of one row has that row's leaf as its root.
An empty table gives an empty result. doc_id is an integer. The result has the
columns stated, and none of the table's others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.ranks import numbered
from lakeferry.llm.scratch import Scratch

ARITY = 3
#: levels that one slot array takes off, and its slots
LEVELS = 3
SLOTS = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: bits of the number of a node's children, in the tree of containers
FAN = 12
#: equal rows that one row of a task is made into
COPIES = 4096
#: arrays that a task turns into Python objects at a time
BATCH_ARRAYS = 128


def field_text(value: Column) -> Column:
    """`-`, or the bytes' number, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(value) for value in values]), 256)


def digest(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def tree_levels(nodes: int) -> int:
    """How many levels of runs lead from so many nodes to one."""
    count = 0
    while nodes > 1:
        nodes, count = -(-nodes // ARITY), count + 1
    return count


def reduced(slots: list[str], levels: int) -> list[list[str]]:
    """The nodes of so many levels above the slots, the slots themselves first."""
    out = [slots]
    for _ in range(levels):
        row = out[-1]
        out.append([digest(*row[i : i + ARITY]) for i in range(0, len(row), ARITY)])
    return out


def siblings(levels: list[list[str]], slot: int) -> list[str]:
    """Of each level but the last: the siblings before and behind a slot's node, joined."""
    path = []
    for row in levels[:-1]:
        first = slot - slot % ARITY
        path.append("".join(row[first:slot]))
        path.append("".join(row[slot + 1 : first + ARITY]))
        slot //= ARITY
    return path


def folded(node: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings lead to."""
    for before, behind in zip(path[::2], path[1::2], strict=True):
        node = digest(before, node, behind)
    return node


# Coordinates, by rank in bitmaps.


def _shifted(value: int, places: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), places.cast("int"))


def _bits_below(place: Column) -> Column:
    """A word with all bits below a place (0 to 63) set."""
    return F.bitwise_not(_shifted(-1, place))


def _low_bits(value: Column) -> Column:
    return value.bitwiseAND(F.lit(63))


def word_bitmaps(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n): the ids of a group by words of 64, and how many rows they are."""
    words = rows.where("id IS NOT NULL").groupBy("grp", F.shiftright("id", 6).alias("word"))
    return words.agg(F.bit_or(_shifted(1, _low_bits(F.col("id")))).alias("bits"), F.count("*").alias("n"))


def containers(words: DataFrame) -> DataFrame:
    """(grp, node, mask, words, before, repeated, n): the words of 4096 ids that have bits, in order.

    The mask tells which these are, `before` how many rows are in the words before
    each, and `repeated` which words have more rows than bits.
    """
    slot = _low_bits(F.col("word")).cast("int").alias("slot")
    held = words.groupBy("grp", F.shiftright("word", 6).alias("node")).agg(
        F.sort_array(F.collect_list(F.struct(slot, "bits", "n"))).alias("w"), F.sum("n").alias("n")
    )
    zero = F.lit(0).cast("long")
    before = F.transform("w", lambda _, i: F.aggregate(F.slice("w", 1, i), zero, lambda t, x: t + x["n"]))
    return held.select(
        "grp",
        "node",
        F.aggregate("w", zero, lambda m, x: m.bitwiseOR(_shifted(1, x["slot"]))).alias("mask"),
        F.transform("w", lambda x: x["bits"]).alias("words"),
        before.alias("before"),
        F.transform("w", lambda x: x["n"] > F.bit_count(x["bits"])).alias("repeated"),
        "n",
    )


def directory(held: DataFrame, scratch: Scratch) -> DataFrame:
    """The containers with `base`, the rows of their group in all containers before.

    Sums go up a tree of up to 4096 children a node, and running sums down again.
    """
    level, levels = held.select("grp", "node", "n"), []
    while True:
        level = scratch.save(level, f"level_{len(levels)}")
        levels.append(level)
        most = level.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
        if most <= 1 << FAN or len(levels) > 64 // FAN:
            break
        level = level.groupBy("grp", F.shiftright("node", FAN).alias("node")).agg(F.sum("n").alias("n"))
    parent, above = F.lit(0).cast("long"), None
    for level in reversed(levels):
        order = Window.partitionBy("grp", "parent").orderBy("node")
        rows = level.withColumn("parent", parent)
        rows = rows.withColumn("base", F.sum("n").over(order) - F.col("n"))
        if above is not None:
            rows = rows.join(above, ["grp", "parent"]).withColumn("base", F.col("base") + F.col("above"))
        above = rows.select("grp", F.col("node").alias("parent"), F.col("base").alias("above"))
        parent = F.shiftright("node", FAN)
    return held.drop("n").join(rows.select("grp", "node", "base"), ["grp", "node"])


def ranked(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows (grp, id, ...) with pos, their rank, and whether it is only that of their repeated word."""
    bitmaps = bitmaps.withColumnRenamed("node", "high")
    joined = rows.withColumn("high", F.shiftright("id", 12)).join(bitmaps, ["grp", "high"])
    at = F.bit_count(F.col("mask").bitwiseAND(_bits_below(_low_bits(F.shiftright("id", 6)))))
    bits = F.get("words", at).bitwiseAND(_bits_below(_low_bits(F.col("id"))))
    start, again = F.col("base") + F.get("before", at), F.get("repeated", at)
    pos = start + F.when(again, 0).otherwise(F.bit_count(bits))
    return joined.select(*rows.columns, pos.alias("pos"), again.alias("again"))


def spread(rows: DataFrame) -> DataFrame:
    """Rows that share a start (grp, pos) at places of their own, by id and leaf."""
    alike = rows.columns
    rows = rows.withColumn("head", F.substring("leaf", 1, 4))
    rows = rows.groupBy(*alike, "head").agg(F.count("*").alias("times"))
    order = Window.partitionBy("grp", "pos").orderBy("id", "head")
    heads = rows.groupBy("grp", "pos", "id", "head").agg(F.sum("times").alias("times"))
    heads = heads.select(
        *[F.col(c).alias(f"of_{c}") for c in ("grp", "pos", "id", "head")],
        (F.sum("times").over(order) - F.col("times")).alias("heads"),
    )
    same = F.lit(True)
    for c in ("grp", "pos", "id", "head"):
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    inside = Window.partitionBy("grp", "pos", "id", "head").orderBy("leaf")
    rows = rows.join(heads, same)
    rows = rows.withColumn("pos", F.col("pos") + F.col("heads") + F.sum("times").over(inside) - F.col("times"))
    # a row for each of the equal rows, however many these are
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(COPIES).cast("long")))
    rows = rows.select(*alike, "times", starts.alias("from")).repartition("grp", "pos", "from")
    last = F.least(F.col("from") + COPIES, F.col("times")) - 1
    rows = rows.select(*alike, F.explode(F.sequence("from", last)).alias("copy"))
    return rows.withColumn("pos", F.col("pos") + F.col("copy")).drop("copy")


# Levels, by slot arrays.


def slot_arrays(nodes: DataFrame) -> DataFrame:
    """(grp, array, n, slots) of nodes (grp, pos, n, node, ...); n is how many nodes the group has."""
    rest = [c for c in nodes.columns if c not in ("grp", "pos", "n")]
    slot = (F.col("pos") % SLOTS).cast("int").alias("slot")
    grouped = nodes.groupBy("grp", F.expr(f"pos div {SLOTS} AS array"))
    return grouped.agg(F.max("n").alias("n"), F.collect_list(F.struct(slot, *rest)).alias("slots"))


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Some arrays at a time, their slots in place."""
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH_ARRAYS):
            arrays = batch.slice(first, BATCH_ARRAYS).to_pylist()
            for one in arrays:
                one["slots"].sort(key=lambda x: x["slot"])
            yield arrays


def _levels(array: dict) -> list[list[str]]:
    return reduced([x["node"] for x in array["slots"]], min(LEVELS, tree_levels(array["n"])))


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for arrays in _arrays(batches):
        rows = [(x["grp"], x["array"], -(-x["n"] // SLOTS), _levels(x)[-1][0]) for x in arrays]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 3, pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["grp", "pos", "n", "node"])


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for arrays in _arrays(batches):
        rows = []
        for array in arrays:
            levels = _levels(array)
            for slot in range(len(array["slots"])):
                path = siblings(levels, slot) + array["path"]
                rows.append((array["grp"], array["array"] * SLOTS + slot, path, array["subroot"]))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["grp", "pos", "path", "subroot"])


def built(nodes: DataFrame, scratch: Scratch, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of all levels, from the lowest, and the last node of each group."""
    arrays = []
    while True:
        arrays.append(scratch.save(slot_arrays(nodes), f"{tag}_{len(arrays)}"))
        nodes = arrays[-1].mapInArrow(_up, "grp long, pos long, n long, node string")
        if (arrays[-1].agg(F.max("n")).first()[0] or 0) <= SLOTS:
            return arrays, scratch.save(nodes, f"{tag}_tops")


def with_paths(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    """The arrays with the path and the subroot of the node above each."""
    return arrays.join(paths.withColumnRenamed("pos", "array"), ["grp", "array"])


def paths_below(arrays: Sequence[DataFrame], paths: DataFrame) -> DataFrame:
    """(grp, pos, path, subroot) of the slots of the lowest of these arrays."""
    for level in reversed(arrays):
        paths = with_paths(level, paths)
        paths = paths.mapInArrow(_down, "grp long, pos long, path array<string>, subroot string")
    return paths


PROVEN = "position long, leaf string, subroot string, proof array<string>, proof_sha256 string, folded_root string"


def _proven(with_proof: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 2, pa.list_(pa.string()))
        names = ["grp", "doc_id", *[field.split()[0] for field in PROVEN.split(", ")]]
        for arrays in _arrays(batches):
            rows = []
            for array in arrays:
                levels = _levels(array)
                for slot, x in enumerate(array["slots"]):
                    path = siblings(levels, slot) + array["path"]
                    rows.append(
                        (
                            array["grp"],
                            x["id"],
                            array["array"] * SLOTS + slot,
                            x["node"],
                            array["subroot"],
                            path if with_proof else None,
                            digest(*path),
                            folded(x["claimed"] or x["node"], path),
                        )
                    )
            columns = zip(zip(*rows), (*kinds, pa.string(), pa.string()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    return run


def proven(
    docs: DataFrame,
    claimed: Column | None = None,
    fields: Sequence[str] = FIELDS,
    doc_id: str = "doc_id",
    source: str = "source",
    proofs: bool = True,
) -> DataFrame:
    """The manifest of a table, a row for each of its rows.

    Columns: the table's doc_id and source, position (in the source, from 0), leaf,
    subroot, root, proof (siblings before and behind, level by level; null if not
    `proofs`), proof_sha256, folded_root and verified. `claimed` is the leaf of the
    row as it is now (null: unchanged); folded_root is what it and the proof lead
    to, and verified whether that is the root.
    """
    scratch = Scratch(docs.sparkSession)
    leaf = leaf_digest([F.col(c) for c in fields])
    claimed = F.lit(None).cast("string") if claimed is None else F.nullif(claimed, leaf)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.col(source).cast("string").alias("source"),
        leaf.alias("node"),
        claimed.alias("claimed"),
    )
    rows = scratch.save(rows, "leaves")
    groups = rows.groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("nulls")
    )
    groups = numbered(groups, [F.col("source").asc_nulls_first()], "grp", scratch, "groups")
    groups = scratch.save(groups.withColumnRenamed("source", "of"), "sources")
    rows = rows.join(groups, F.col("source").eqNullSafe(F.col("of"))).drop("source", "of")

    held = scratch.save(containers(word_bitmaps(rows)), "containers")
    bitmaps = scratch.save(directory(held, scratch), "bitmaps")
    found = ranked(rows.where("id IS NOT NULL"), bitmaps).withColumn("pos", F.col("pos") + F.col("nulls"))
    unnumbered = rows.where("id IS NULL").withColumns({"pos": F.lit(0).cast("long"), "again": F.lit(True)})
    found = scratch.save(found.unionByName(unnumbered).drop("nulls"), "ranked")
    nodes = found.where("NOT again").drop("again")
    again = found.where("again").drop("again").withColumnRenamed("node", "leaf")
    if not again.isEmpty():
        nodes = nodes.unionByName(spread(again).withColumnRenamed("leaf", "node"))

    arrays, tops = built(nodes, scratch, "arrays")
    zero = F.lit(0).cast("long")
    many = F.lit(groups.count()).cast("long")
    subroots = tops.select(zero.alias("grp"), F.col("grp").alias("pos"), many.alias("n"), "node")
    source_arrays, last = built(subroots, scratch, "source_arrays")
    root = last.first()
    none = F.array().cast("array<string>")
    paths = last.select("grp", "pos", none.alias("path"), F.col("node").alias("subroot"))
    paths = paths_below(source_arrays, paths)
    paths = paths.select(F.col("pos").alias("grp"), zero.alias("pos"), "path")
    paths = scratch.save(paths.join(tops.select("grp", F.col("node").alias("subroot")), "grp"), "paths")
    paths = paths_below(arrays[1:], paths)
    out = with_paths(arrays[0], paths).mapInArrow(_proven(proofs), f"grp long, doc_id long, {PROVEN}")
    out = out.join(groups.select("grp", "of"), "grp")
    whole = F.lit(root["node"] if root else None).cast("string")
    result = [field.split()[0] for field in PROVEN.split(", ")]
    return out.select(
        F.col("doc_id").alias(doc_id),
        F.col("of").alias(source),
        *result[:3],
        whole.alias("root"),
        *result[3:],
        (F.col("folded_root") == whole).alias("verified"),
    )
