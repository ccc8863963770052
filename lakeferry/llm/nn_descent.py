"""Near-duplicates of embeddings by NN-descent.

Each vector keeps a list of the `K` nearest others that it knows. Lists begin
with neighbours in cells of random hyperplanes, and are refined by descent: in
each round, the neighbours of a vector, and a sample of those that list it, are
compared with each other, if one of the two is new to the list, and each enters
the lists of the others where it is nearer than the last one there. Rounds end
when few lists change. Vectors travel as bytes for this (127 times the unit
vector, rounded).

Listed pairs of about 0.9 and more are verified in double precision; what is
linked (cosine of 0.9 or more) forms components. A list of `K` is too short for
a vector with more links: it may hold none but those of its own component.
Vectors with such saturated lists search again, for the nearest in components
other than their own (as floats, so that the nearest comes first), until no two
components are linked any more. Before that, components that can have no such
link are left out by their geometry: two vectors are linked only if the centres of their
components are no farther apart than both radii and the angle of a link, and
centres find those near them by NN-descent as well. Each component is then compared with itself in
blocks of `BLOCK` vectors, in double precision. That gives the links of every
vector without writing out pairs.

Recall is audited: `AUDIT` vectors, chosen by hash, and as many of those outside
components of over `BLOCK` vectors, are compared with all others. While the
share of its links that a vector has, averaged over either sample, is under
`TARGET`, the search goes on with twice the cells and twice the lists, up to
`ATTEMPTS` times; then it fails.

No group grows with the data: a cell of many vectors is split by hash, those who
list a vector are sampled, a component is compared block by block.

Defined results: a vector that is null, zero, or holds a null or a non-finite
component links with nothing. Vectors of equal components are one for the
search, and linked with each other. Shorter vectors count as continued by
zeros. Rows that repeat vec_id and vector are one vector. A null vec_id has the
smallest other vec_id of its component, or null. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.linking import components
from lakeferry.llm.scratch import Scratch

THRESHOLD = 0.9
K = 16
TREES = 4
CELL, CELL_MOST = 64, 256
ROUNDS = 8
#: rounds end when fewer entries of all lists than this share are new
CHANGED = 0.005
BLOCK = 512
AUDIT, TARGET, ATTEMPTS = 256, 0.95, 3
#: what a cosine of byte vectors may be off
SLACK = 0.03


def _unit(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Unit vectors: doubles (as bytes), and rounded to bytes."""
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy())
        rows = np.zeros((len(lists), width))
        rows[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        rows /= np.abs(rows).max(1, keepdims=True)
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        exact = [row.tobytes() for row in rows]
        coarse = [row.tobytes() for row in np.rint(rows * 127).astype(np.int8)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(exact, pa.binary()), pa.array(coarse, pa.binary())],
            names=["id", "exact", "coarse"],
        )


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A row of numbers for each entry of a column of equally long bytes."""
    if not len(column):
        return np.zeros((0, 0), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), -1)


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The runs of equal keys of sorted batches; a run may begin in the batch before."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        table = table.combine_chunks()
        n = table.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        edges = np.concatenate(([0], np.flatnonzero(change)))
        whole = table.to_batches()[0]
        for start, end in zip(edges, edges[1:]):
            yield whole.slice(start, end - start)
        rest = table.slice(edges[-1])
    if rest is not None:
        yield rest.combine_chunks().to_batches()[0]


def _pairs_batch(u, v, sim) -> pa.RecordBatch:
    u, v, sim = (np.concatenate(x) if x else np.zeros(0) for x in (u, v, sim))
    return pa.RecordBatch.from_arrays(
        [pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64)), pa.array(sim.astype(np.float32))],
        names=["u", "v", "sim"],
    )


def _compared(group: pa.RecordBatch, kind: type) -> np.ndarray:
    """The cosines of the vectors of a group; -2 within a component."""
    rows = _matrix(group.column("coarse"), kind).astype(np.float32)
    rows = rows / 127 if kind is np.int8 else rows
    component = group.column("component").to_numpy()
    near = rows @ rows.T
    near[component[:, None] == component] = -2
    return near


def _nearest_in_cell(k: int, kind: type):
    """Of each vector of a cell, the nearest others there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("tree", "code", "part")):
            if group.num_rows < 2:
                continue
            ids = group.column("id").to_numpy()
            near = _compared(group, kind)
            most = min(k, len(ids) - 1)
            best = np.argpartition(near, -most, axis=1)[:, -most:]
            sims = np.take_along_axis(near, best, 1)
            a, b = np.nonzero(sims > -1.5)
            yield _pairs_batch([ids[a]], [ids[best[a, b]]], [sims[a, b]])

    return run


def _joined_locally(k: int, kind: type):
    """Pairs of a vector's neighbours that are nearer than the last in a list of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v, sim, held = [], [], [], 0
        for group in groups(batches, ("w",)):
            new = group.column("new").to_numpy(zero_copy_only=False)
            if group.num_rows > 1 and new.any():
                ids = group.column("id").to_numpy()
                last = group.column("last").to_numpy()
                near = _compared(group, kind)
                a, b = np.nonzero((near > last[:, None]) & (new[:, None] | new))
                u.append(ids[a])
                v.append(ids[b])
                sim.append(near[a, b])
                held += len(a)
            if held > 200_000:
                yield _best(u, v, sim, k)
                u, v, sim, held = [], [], [], 0
        if held:
            yield _best(u, v, sim, k)

    return run


def _best(u: list, v: list, sim: list, k: int) -> pa.RecordBatch:
    """At most k pairs of each u, without repeats: the nearest."""
    u, v, sim = (np.concatenate(x) for x in (u, v, sim))
    order = np.lexsort((v, -sim, u))
    u, v, sim = u[order], v[order], sim[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, sim = u[new], v[new], sim[new]
    begin = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
    rank = np.arange(len(u)) - np.repeat(begin, np.diff(np.append(begin, len(u))))
    keep = rank < k
    return _pairs_batch([u[keep]], [v[keep]], [sim[keep]])


def _lists(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each u: (u, v, sim, new). A pair that is there as old stays old."""
    once = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    every = F.sort_array(F.collect_list(F.struct("sim", "v", "new")), asc=False)
    best = once.groupBy("u").agg(F.slice(every, 1, k).alias("list"))
    return best.select("u", F.explode("list").alias("x")).select("u", "x.v", "x.sim", "x.new")


def _cells(
    units: DataFrame, trees: int, bits: int, width: int, seed: int, scratch: Scratch, tag: str, kind: type
) -> DataFrame:
    """Every vector once for each tree, with the cell it lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((width, trees * bits)).astype(np.float32)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            side = _matrix(batch.column("coarse"), kind).astype(np.float32) @ planes > 0
            codes = side.reshape(n, trees, bits) @ (1 << np.arange(bits, dtype=np.int64))
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("coarse"),
                        batch.column("component"),
                        pa.array(np.full(n, tree), pa.int32()),
                        pa.array(codes[:, tree], pa.int64()),
                    ],
                    names=["id", "coarse", "component", "tree", "code"],
                )

    cells = units.select("id", "coarse", "component").mapInArrow(
        run, "id long, coarse binary, component long, tree int, code long"
    )
    sizes = cells.groupBy("tree", "code").agg(F.ceil(F.count("*") / CELL_MOST).alias("parts"))
    cells = cells.join(scratch.save(sizes, f"{tag}_sizes"), ["tree", "code"])
    return cells.withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))


def neighbour_lists(
    units: DataFrame,
    width: int,
    trees: int,
    seed: int,
    scratch: Scratch,
    tag: str,
    k: int = K,
    within: DataFrame | None = None,
    kind: type = np.int8,
) -> DataFrame:
    """(u, v, sim) of the lists of k after descent. `units` has id, coarse (of a kind) and component.

    Lists hold vectors of components other than u's. With `within`, lists (u, v)
    inside components, the descent goes along these as well.
    """
    n = units.count()
    bits = max(1, int(np.ceil(np.log2(max(n, 2) / CELL))))
    if n <= CELL:
        trees, bits = 1, 0  # one cell, in which all are compared with all
    cells = _cells(units, trees, bits, width, seed, scratch, tag, kind)
    near = cells.repartition("tree", "code", "part").sortWithinPartitions("tree", "code", "part")
    pairs = near.mapInArrow(_nearest_in_cell(k, kind), "u long, v long, sim float")
    lists = scratch.save(_lists(pairs.withColumn("new", F.lit(True)), k), f"{tag}_0")
    if n <= CELL:
        return lists.select("u", "v", "sim")
    for turn in range(1, ROUNDS + 1):
        last = lists.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).alias("last"))
        known = units.select("id", "coarse", "component").join(last.withColumnRenamed("u", "id"), "id", "left")
        known = known.withColumn("last", F.coalesce("last", F.lit(-1.0)).cast("float"))
        forward = lists.select(F.col("u").alias("w"), F.col("v").alias("id"), "new")
        listed = lists.groupBy("v").agg(F.count("*").alias("n"))
        backward = lists.join(listed, "v").where(
            F.pmod(F.xxhash64("u", "v", F.lit(turn)), F.col("n")) < k
        )
        backward = backward.select(F.col("v").alias("w"), F.col("u").alias("id"), "new")
        own = units.select(F.col("id").alias("w"), "id", F.lit(False).alias("new"))
        members = forward.unionByName(backward).unionByName(own)
        if within is not None:
            inside = within.select(F.col("u").alias("w"), F.col("v").alias("id"))
            members = members.unionByName(inside.withColumn("new", F.lit(False)))
        members = members.groupBy("w", "id").agg(F.max("new").alias("new")).join(known, "id")
        members = members.repartition("w").sortWithinPartitions("w")
        found = members.mapInArrow(_joined_locally(k, kind), "u long, v long, sim float")
        old = lists.withColumn("new", F.lit(False))
        lists = _lists(old.unionByName(found.withColumn("new", F.lit(True))), k)
        lists = scratch.save(lists, f"{tag}_{turn}")
        scratch.drop(f"{tag}_{turn - 1}")
        if lists.where("new").count() < CHANGED * n * k:
            break
    return lists.select("u", "v", "sim")


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_matrix(batch.column(c), np.float64) for c in ("x", "y"))
                near = (x * y).sum(1) >= threshold
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _counted(threshold: float):
    """Of each vector of a pair of blocks, how many vectors of the other it is linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("component", "low", "high")):
            ids = group.column("id").to_numpy()
            times = group.column("times").to_numpy()
            rows = _matrix(group.column("exact"), np.float64)
            block = group.column("block").to_numpy()
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
            linked = rows[a] @ rows[b].T >= threshold
            if low == high:
                np.fill_diagonal(linked, False)
                who, n = ids[a], linked @ times[b]
            else:
                who = np.concatenate((ids[a], ids[b]))
                n = np.concatenate((linked @ times[b], times[a] @ linked))
            yield pa.RecordBatch.from_arrays(
                [pa.array(who), pa.array(n.astype(np.int64))], names=["id", "n"]
            )

    return run


def _verified_links(units: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the listed pairs that are linked."""
    near = lists.where(F.col("sim") >= threshold - SLACK)
    near = near.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    x = units.select(F.col("id").alias("a"), F.col("exact").alias("x"))
    y = units.select(F.col("id").alias("b"), F.col("exact").alias("y"))
    return near.join(x, "a").join(y, "b").mapInArrow(_verified(threshold), "a long, b long")


def _floats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, unit vectors as floats (as bytes), and components."""
    for batch in batches:
        rows = _matrix(batch.column("exact"), np.float64).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([row.tobytes() for row in rows], pa.binary()),
                batch.column("component"),
            ],
            names=["id", "coarse", "component"],
        )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the vectors of each component in a batch, as doubles (as bytes)."""
    for batch in batches:
        if batch.num_rows:
            named, place = np.unique(batch.column("component").to_numpy(), return_inverse=True)
            rows = _matrix(batch.column("coarse"), np.float32).astype(np.float64)
            total = np.zeros((len(named), rows.shape[1]))
            np.add.at(total, place, rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(named), pa.array([x.tobytes() for x in total], pa.binary())],
                names=["component", "total"],
            )


def _centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The direction of the sums of each component, sorted by it, as floats."""
    for group in groups(batches, ("component",)):
        if group.num_rows:
            total = _matrix(group.column("total"), np.float64).sum(0)
            size = np.linalg.norm(total)
            centre = (total / size if size else total).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [group.column("component").slice(0, 1), pa.array([centre.tobytes()], pa.binary())],
                names=["component", "centre"],
            )


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The widest angle between centre and vectors of each component in a batch."""
    for batch in batches:
        if batch.num_rows:
            x, y = (_matrix(batch.column(c), np.float32) for c in ("coarse", "centre"))
            angle = np.arccos(np.clip((x * y).sum(1, dtype=np.float64), -1, 1))
            named, place = np.unique(batch.column("component").to_numpy(), return_inverse=True)
            widest = np.zeros(len(named))
            np.maximum.at(widest, place, angle)
            yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(widest)], names=["component", "angle"])


#: what an angle of floats may be off
ANGLE_SLACK = 0.01


def near_components(
    some: DataFrame, width: int, trees: int, seed: int, threshold: float, scratch: Scratch, tag: str
) -> DataFrame:
    """The components of some vectors (id, coarse as floats, component) that may be linked with others."""
    sums = some.select("component", "coarse").mapInArrow(_sums, "component long, total binary")
    sums = sums.repartition("component").sortWithinPartitions("component")
    centres = sums.mapInArrow(_centred, "component long, centre binary")
    centres = scratch.save(centres, f"{tag}_centres")
    angles = some.select("component", "coarse").join(centres, "component")
    angles = angles.mapInArrow(_angles, "component long, angle double")
    radii = angles.groupBy("component").agg(F.max("angle").alias("radius"))
    radii = scratch.save(radii, f"{tag}_radii")
    widest = radii.agg(F.max("radius")).first()[0]
    units = centres.select(
        F.col("component").alias("id"), F.col("centre").alias("coarse"), F.col("component")
    )
    lists = neighbour_lists(units, width, trees, seed, scratch, f"{tag}_near_", K, kind=np.float32)
    link = float(np.arccos(threshold)) + ANGLE_SLACK
    mine = radii.select(F.col("component").alias("u"), F.col("radius").alias("mine"))
    theirs = radii.select(F.col("component").alias("v"), F.col("radius").alias("theirs"))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sim").cast("double"))))
    seen = lists.join(mine, "u").join(theirs, "v").withColumn("angle", angle)
    # beyond a full list there may be wider components
    seen = seen.groupBy("u").agg(
        F.max(F.col("angle") <= F.col("mine") + F.col("theirs") + link).alias("listed"),
        (F.count("*") >= K).alias("full"),
        F.max(F.col("angle") - F.col("mine")).alias("last"),
    )
    seen = seen.where(F.col("listed") | (F.col("full") & (F.col("last") <= widest + link)))
    return scratch.save(seen.select(F.col("u").alias("component")), f"{tag}_possible")


def _joined_components(
    units: DataFrame,
    lists: DataFrame,
    width: int,
    trees: int,
    seed: int,
    threshold: float,
    scratch: Scratch,
    tag: str,
    k: int,
) -> DataFrame:
    """(id, component) of vectors with links, after components that are linked are joined."""
    links = scratch.save(_verified_links(units, lists, threshold), f"{tag}_links")
    found = components(links, scratch, tag)
    # a list that is not full of what may be linked holds all links of its vector
    full = lists.where(F.col("sim") >= threshold - SLACK).groupBy("u").agg(F.count("*").alias("n"))
    full = full.where(F.col("n") >= K).select(F.col("u").alias("id"))
    full = scratch.save(units.select("id", "exact").join(full, "id"), f"{tag}_full")
    turn, within = 0, None
    while True:
        some = full.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        some = some.mapInArrow(_floats, "id long, coarse binary, component long")
        some = scratch.save(some, f"{tag}_some{turn}")
        if some.select("component").distinct().limit(2).count() < 2:
            return found
        near = near_components(some, width, trees, seed + turn, threshold, scratch, f"{tag}_turn{turn}")
        if near.isEmpty():
            return found
        some = scratch.save(some.join(near, "component").select("id", "coarse", "component"), f"{tag}_near{turn}")
        if within is None:
            within = lists.join(full.select(F.col("id").alias("u")), "u").select("u", "v")
            within = scratch.save(within.distinct(), f"{tag}_within")
        inside = within.join(some.select(F.col("id").alias("u")), "u").join(some.select(F.col("id").alias("v")), "v")
        across = neighbour_lists(
            some, width, trees, seed + turn, scratch, f"{tag}_across{turn}_", k, inside, np.float32
        )
        more = scratch.save(_verified_links(units, across, threshold), f"{tag}_more{turn}")
        if more.isEmpty():
            return found
        stars = found.select(F.col("component").alias("a"), F.col("id").alias("b"))
        found = components(stars.unionByName(more), scratch, f"{tag}_joined{turn}")
        turn += 1


def _links(units: DataFrame, found: DataFrame, threshold: float, scratch: Scratch, tag: str) -> DataFrame:
    """(id, component, size, n): of vectors with links, the component and how many they are."""
    heads = found.select(F.col("component").alias("id"), "component").distinct()
    members = scratch.save(found.unionByName(heads), f"{tag}_members")
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    members = members.join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = members.join(units.select("id", "exact", "times"), "id").select("*", other.alias("other"))
    rows = rows.select(
        "id",
        "exact",
        "times",
        "component",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    keys = ["component", "low", "high"]
    counts = rows.repartition(*keys).sortWithinPartitions(*keys)
    counts = counts.mapInArrow(_counted(threshold), "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    return scratch.save(members.select("id", "component", "size").join(counts, "id"), f"{tag}_found")


def recall(
    units: DataFrame, found: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT
) -> float:
    """The share of its links that a vector has, of some vectors compared with all others.

    The lower average of two samples: of all vectors, and of those outside
    components of over `BLOCK` vectors. Vectors without links don't count.
    """
    units = units.join(found.select("id", "size", "n"), "id", "left")
    some = units.select("id", "exact", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "n")])
    order = F.xxhash64("id", F.lit(5))
    table = pa.concat_tables(
        sample.orderBy(order, "id").limit(queries).toArrow()
        for sample in (some, some.where(F.col("size") <= BLOCK))
    )
    if not table.num_rows:
        return 1.0
    sent = units.sparkSession.sparkContext.broadcast(table.combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = sent.value.to_batches()[0]
        ids, rows = whole.column("id").to_numpy(), _matrix(whole.column("exact"), np.float64)
        total = np.zeros(len(ids))
        for batch in batches:
            if batch.num_rows:
                linked = _matrix(batch.column("exact"), np.float64) @ rows.T >= threshold
                linked &= batch.column("id").to_numpy()[:, None] != ids
                total += batch.column("times").to_numpy() @ linked
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(ids))), pa.array(total.astype(np.int64))], names=["place", "there"]
        )

    there = units.select("id", "exact", "times").mapInArrow(run, "place long, there long")
    there = {r.place: r.there for r in there.groupBy("place").agg(F.sum("there").alias("there")).collect()}
    got = [
        (place < queries, min(n, there[place]) / there[place])
        for place, n in enumerate(table.column("n").to_pylist())
        if there.get(place)
    ]
    samples = ([share for of_all, share in got if of_all == side] for side in (True, False))
    return min((sum(shares) / len(shares) for shares in samples if shares), default=1.0)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def linked_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    # so that -0.0 is 0.0
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.distinct().withColumn("usable", _usable(F.col("vector")))
    rows = scratch.save(rows, "rows")
    classes = rows.where("usable").groupBy("vector")
    classes = classes.agg(F.min("vec_id").alias("first"), F.count("*").alias("times"))
    classes = scratch.save(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    units = classes.select("id", "vector").mapInArrow(
        lambda batches: _unit(batches, width), "id long, exact binary, coarse binary"
    )
    units = scratch.save(units.join(classes.select("id", "times"), "id"), "units")

    lists, trees, k = None, TREES, K
    for attempt in range(ATTEMPTS):
        alone = units.select("id", "coarse", F.col("id").alias("component"))
        more = neighbour_lists(alone, width, trees, attempt, scratch, f"lists{attempt}", k)
        lists = more if lists is None else lists.unionByName(more).distinct()
        joined = _joined_components(
            units, lists, width, trees, 100 * (attempt + 1), threshold, scratch, f"links{attempt}", k
        )
        found = _links(units, joined, threshold, scratch, f"found{attempt}")
        reached = recall(units, found, threshold)
        if reached >= TARGET:
            break
        trees, k = 2 * trees, 2 * k
    else:
        raise RuntimeError(f"the audit found {reached:.3f} of the links; allow more attempts")

    classes = classes.join(found, "id", "left").select(
        "vector",
        (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
        "first",
    )
    heads = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(heads, "component").select("vector", "n_links", "component_id")
    used = rows.where("usable").join(classes, "vector").select("vec_id", "n_links", "component_id")
    rest = rows.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return used.unionByName(rest).withColumn("kept", kept)
