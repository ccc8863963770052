"""Suffix-array dedup: bytes of repeated 100-byte strings go, but for the first one.

A text is its UTF-8 bytes; matches never cross documents. A byte is removed if a
100-byte string that covers it also starts earlier: in a document of smaller
doc_id, or earlier in the same one. Strings are judged on the input.

No suffix array of the whole corpus is made, and none is needed. Each 100-byte string has
an anchor, the 40-byte piece of it with the smallest hash, so equal strings have
equal anchors at equal places. The strings of one anchor in a text are a run; what
they cover is a segment of 100 to 160 bytes. So:

1. Anchors that occur once, in one text, have no repeats. Their number follows
   the bytes (3 %); only a hash of each is shuffled for this.
2. Equal segments of one anchor are collapsed. All but the first occurrence are
   removed whole, wherever they are. Copies of whole texts go this way before.
3. The different segments of one anchor are the strings of a generalised suffix
   array (`grouping.py`), in which the anchor's bytes are one symbol. Suffixes
   that share the symbols of 100 bytes are equal strings; all but the first are
   removed. Thousands of these small arrays are built in step in each task.
4. An anchor with more than `MOST` different segments (a very common phrase) is
   divided before it is put into arrays. Its strings are taken in blocks of
   neighbours, counted from the anchor, and a block has a second anchor: what all its strings have
   in common, 85 bytes or more. The strings of a segment in one block are a shorter segment;
   equal ones are collapsed as in step 2. What is still too large is divided again
   into smaller blocks, at last of one string. Equal strings have equal anchors at every
   step, so none is lost, and no array grows with the data.

Defined results: null counts as empty; texts of under 100 bytes lose nothing; a
document without doc_id comes after all others; rows that repeat doc_id and text
are one document, each with its result; different texts of one doc_id (told apart
by 19 bits of their hashes) stand in the order of these. doc_id is an integer. Empty tables give empty results.
Other columns pass through, but for those named like a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.grouping import suffix_arrays
from lakeferry.llm.scratch import Scratch, free_name
from lakeferry.llm.words import as_bytes, mix, parts, powers, prefix_hashes

SPAN = 100
GRAM = 40
#: symbols of a string when its anchor is one symbol
LENGTH = SPAN - GRAM + 1
#: different segments that one array may hold
MOST = 64
#: strings of a block in each division of a large anchor
BLOCKS = (16, 4, 1)
PART_BYTES = 1 << 20
BATCH_SYMBOLS = 300_000
RESULT = ("kept", "n_bytes", "n_removed", "n_spans")

_SEPARATOR, _ANCHOR = 1, 258

#: at most so many copies (16 bytes each) are sent to all tasks; more are joined by a shuffle
BROADCAST_ROWS = 100_000


def _packed(tag: np.ndarray, start: np.ndarray, strings: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where a run is, in one number that sorts by text and start: 19, 32, 6 and 6 bits."""
    return (tag << 44) | (start << 12) | (strings << 6) | anchor


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return at >> 44, (at >> 12) & 0xFFFFFFFF, (at >> 6) & 63, at & 63


def _tag(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 45)


def _start(at: Column) -> Column:
    return F.shiftright(at, 12).bitwiseAND(F.lit(0xFFFFFFFF))


def _strings_of(at: Column) -> Column:
    return F.shiftright(at, 6).bitwiseAND(F.lit(63))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Anchors:
    """The runs of strings of some texts that have one anchor.

    For each run: the first and last string (`first`, `last`), the anchor
    (`place`), all as places in the bytes, and the text they are in.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        sizes = np.maximum(np.diff(starts) - SPAN + 1, 0)
        self.starts = starts
        self.sums, self.down = prefix_hashes(data), powers(len(data) + 1)[1]
        if not sizes.any():
            self.first = self.last = self.place = self.text = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        hashes = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * self.down[: len(data) - GRAM + 1])
        least, step = hashes, 1
        while 2 * step <= LENGTH:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        least = np.minimum(least[: len(hashes) - LENGTH + 1], least[LENGTH - step :])
        string, text = _ranges(starts[:-1], sizes), np.repeat(np.arange(len(sizes)), sizes)
        value = least[string]
        new = np.ones(len(string), bool)
        new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        first, text = string[begin], text[begin]
        last = string[np.append(begin[1:], len(string)) - 1]
        view = np.lib.stride_tricks.sliding_window_view(hashes, LENGTH)
        place = first + view[first].argmin(1)
        # where equal pieces repeat nearby, a run goes on behind its first anchor
        over = np.flatnonzero(last > place)
        if len(over):
            size = last[over] - place[over]
            more, of = _ranges(place[over] + 1, size), np.repeat(text[over], size)
            at = np.concatenate(
                [some + view[some].argmin(1) for some in np.array_split(more, len(more) // 50_000 + 1)]
            )
            new = np.ones(len(more), bool)
            new[1:] = (at[1:] != at[:-1]) | (np.diff(more) != 1)
            begin = np.flatnonzero(new)
            last[over] = place[over]
            first = np.concatenate((first, more[begin]))
            last = np.concatenate((last, more[np.append(begin[1:], len(more)) - 1]))
            place, text = np.concatenate((place, at[begin])), np.concatenate((text, of[begin]))
        self.first, self.last, self.place, self.text = first, last, place, text
        self.hash = hashes[place]

    def segments(self) -> np.ndarray:
        """Hashes of what the strings of each run cover, and of where the anchor is in it."""
        end = self.last + SPAN
        covered = (self.sums[end] - self.sums[self.first]) * self.down[self.first]
        shape = (self.place - self.first) * 256 + (self.last - self.first)
        return mix(covered ^ mix(shape.astype(np.uint64) + np.uint64(1)))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES):
            runs = Anchors(*as_bytes(part.column("text")))
            tag = part.column("tag").to_numpy()
            where = _packed(
                tag[runs.text],
                runs.first - runs.starts[runs.text],
                runs.last - runs.first + 1,
                runs.place - runs.first,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.hash.view(np.int64)),
                    pa.array(runs.segments().view(np.int64)),
                    part.column("doc_id").take(pa.array(runs.text)),
                    pa.array(where, pa.int64()),
                ],
                names=["key", "segment", "doc_id", "at"],
            )


PIECES = "key long, doc_id long, at long, body binary"


def _bodies(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    raw = data[_ranges(begin, size)].tobytes()
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each document."""
    for batch in batches:
        for part in parts(batch, "text", PART_BYTES):
            data, starts = as_bytes(part.column("text"))
            wanted = part.column("wanted")
            rows = np.repeat(np.arange(part.num_rows), np.diff(wanted.offsets.to_numpy()))
            fields = wanted.flatten()
            at = fields.field("at").to_numpy()
            _, start, strings, _ = _unpacked(at)
            body = _bodies(data, starts[rows] + start, strings + SPAN - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    fields.field("key"),
                    part.column("doc_id").take(pa.array(rows)),
                    pa.array(at),
                    body,
                ],
                names=["key", "doc_id", "at", "body"],
            )


class Pieces:
    """Segments with their bytes, those of one anchor next to each other."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        self.key = table.column("key").to_numpy()
        doc_id = table.column("doc_id").combine_chunks()
        self.none = doc_id.is_null().to_numpy(zero_copy_only=False)
        self.doc_id = doc_id.fill_null(0).to_numpy()
        self.tag, self.start, self.strings, self.anchor = _unpacked(table.column("at").to_numpy())
        body = table.column("body").combine_chunks().cast(pa.large_binary())
        self.data, self.offset = as_bytes(body.view(pa.large_string()))  # may cut characters
        self.rows = np.repeat(np.arange(len(self.key)), self.strings)
        #: of each string, its number in its segment
        self.number = _ranges(np.zeros(len(self.key), np.int64), self.strings)

    def symbols(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The strings for the suffix arrays, their bounds, and where each segment begins."""
        size = np.diff(self.offset)
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) - self.offset[row] - self.anchor[row]
        keep = (at <= 0) | (at >= GRAM)
        values = np.where(at == 0, _ANCHOR, self.data.astype(np.int64) + 2)[keep]
        # behind each segment a separator, behind the last of an anchor the end
        long_ = size - GRAM + 2
        end = np.cumsum(long_)
        out = np.full(end[-1], _SEPARATOR, np.int64)
        out[np.cumsum(keep)[keep] - 1 + row[keep]] = values
        last = np.flatnonzero(np.append(self.key[1:] != self.key[:-1], True))
        out[end[last] - 1] = 0
        return out, np.concatenate(([0], end[last])), end - long_

    def later(self) -> np.ndarray:
        """Whether each string is equal to an earlier one, by the suffix arrays."""
        symbols, bounds, begin = self.symbols()
        string = np.full(len(symbols), -1)
        string[begin[self.rows] + self.number] = np.arange(len(self.rows))
        order = string[suffix_arrays(symbols, bounds)]
        order = order[order >= 0]
        # neighbours in the array whose first symbols are equal
        up, down = powers(len(symbols) + 1)
        codes = mix(symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes, dtype=np.uint64)))
        at = begin[self.rows[order]] + self.number[order]
        prefix = (sums[at + LENGTH] - sums[at]) * down[at]
        key = self.key[self.rows[order]]
        new = np.ones(len(order), bool)
        new[1:] = (prefix[1:] != prefix[:-1]) | (key[1:] != key[:-1])
        group = np.cumsum(new)
        row = self.rows[order]
        place = self.start[row] + self.number[order]
        sort = np.lexsort((place, self.tag[row], self.doc_id[row], self.none[row], group))
        head = np.ones(len(order), bool)
        head[1:] = group[sort][1:] != group[sort][:-1]
        first = sort[np.flatnonzero(head)][np.cumsum(head) - 1]
        # rows that repeat a document give its strings again, at the same place
        same = np.ones(len(order), bool)
        for column in (place, self.tag[row], self.doc_id[row], self.none[row]):
            same &= column[sort] == column[first]
        out = np.zeros(len(order), bool)
        out[order[sort]] = ~same
        return out

    def spans(self) -> pa.RecordBatch:
        """What later strings cover: doc_id, tag, start and end."""
        gone = np.flatnonzero(self.later())
        row, number = self.rows[gone], self.number[gone]
        new = np.ones(len(gone), bool)
        new[1:] = (row[1:] != row[:-1]) | (np.diff(number) != 1)
        begin = np.flatnonzero(new)
        end = number[np.append(begin[1:], len(gone)) - 1] if len(gone) else number
        row, number = row[begin], number[begin]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.doc_id[row], pa.int64(), mask=self.none[row]),
                pa.array(self.tag[row]),
                pa.array(self.start[row] + number),
                pa.array(self.start[row] + end + SPAN),
            ],
            names=["doc_id", "tag", "start", "end"],
        )


def _by_suffix_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of segments sorted by key: as many anchors at a time as make a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in parts(batch, "body", BATCH_SYMBOLS):
            held.append(part)
            if sum(x.column("body").nbytes for x in held) < BATCH_SYMBOLS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            edge = np.flatnonzero(key[1:] != key[:-1])
            if len(edge):  # the last anchor may go on
                yield Pieces(table.slice(0, edge[-1] + 1)).spans()
                table = table.slice(edge[-1] + 1)
            held = table.to_batches()
    if held and sum(x.num_rows for x in held):
        yield Pieces(pa.Table.from_batches(held)).spans()


def _dividers(pieces: Pieces, block: int) -> np.ndarray:
    """Of each string a hash of what it shares with all strings of its block."""
    sums, down = prefix_hashes(pieces.data), powers(len(pieces.data) + 1)[1]
    anchor = pieces.anchor[pieces.rows]
    behind = pieces.number + LENGTH - 1 - anchor  # bytes of the string behind the anchor
    right = behind // block * block
    left = np.maximum(LENGTH - block - right, 0)
    begin = pieces.offset[pieces.rows] + anchor - left
    end = begin + left + GRAM + right
    return mix((sums[end] - sums[begin]) * down[begin] ^ mix((left * 64 + right).astype(np.uint64)))


def _divided(block: int):
    """Segments of large anchors as shorter ones, those of the strings of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "body", BATCH_SYMBOLS):
                pieces = Pieces(pa.Table.from_batches([part]))
                value = _dividers(pieces, block)
                new = np.ones(len(value), bool)
                new[1:] = (value[1:] != value[:-1]) | (pieces.rows[1:] != pieces.rows[:-1])
                first = np.flatnonzero(new)
                row, number = pieces.rows[first], pieces.number[first]
                strings = np.diff(np.append(first, len(value)))
                anchor = pieces.anchor[row] - number
                begin, size = pieces.offset[row] + number, strings + SPAN - 1
                sums, down = prefix_hashes(pieces.data), powers(len(pieces.data) + 1)[1]
                shape = mix((anchor * 64 + strings).astype(np.uint64))
                segment = mix((sums[begin + size] - sums[begin]) * down[begin] ^ shape)
                key = mix(pieces.key[row].astype(np.uint64) ^ mix(value[first] + np.uint64(block)))
                at = _packed(pieces.tag[row], pieces.start[row] + number, strings, anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(segment.view(np.int64)),
                        part.column("doc_id").take(pa.array(row)),
                        pa.array(at),
                        _bodies(pieces.data, begin, size),
                    ],
                    names=["key", "segment", "doc_id", "at", "body"],
                )

    return run


def _same(left: str, right: str) -> Column:
    ids = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    return ids & (F.col(f"{left}.tag") == F.col(f"{right}.tag"))


def _first() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")).alias("f")


def _later(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """What rows cover that are not the first of their keys: doc_id, tag, start and end."""
    rows = rows.join(firsts.where("times > 1").select(*keys, "f"), keys)
    mine = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("at") == F.col("f.at"))
    start = _start(F.col("at"))
    return rows.where(~mine).select(
        "doc_id",
        F.shiftright("at", 44).alias("tag"),
        start.alias("start"),
        (start + _strings_of(F.col("at")) + F.lit(SPAN - 1)).alias("end"),
    )


def _firsts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(_first(), F.count("*").alias("times"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What goes of each document: doc_id, tag (of its text), start and end of a span.

    Spans of a document may overlap.
    """
    scratch = Scratch(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    number = F.col(doc_id).cast("long").alias("doc_id")
    marked = docs.select(number, whole.alias("text"), _tag(whole).alias("tag"))

    # copies of whole texts
    size = F.octet_length("text").cast("long").alias("n")
    texts = marked.select("doc_id", "tag", F.md5("text").alias("md5"), size)
    texts = texts.where(F.col("n") >= SPAN).distinct().withColumn("at", F.col("tag"))
    texts = scratch.save(texts, "texts")
    firsts = _firsts(texts, ["md5", "n"]).where("times > 1").select("md5", "n", "f")
    firsts = scratch.save(firsts, "first_texts")
    mine = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("at") == F.col("f.at"))
    copies = texts.join(firsts, ["md5", "n"]).where(~mine)
    copies = copies.select("doc_id", "tag", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))
    copies = scratch.save(copies, "copies")
    few = copies.count() <= BROADCAST_ROWS

    def without_copies(rows: DataFrame) -> DataFrame:
        gone = F.broadcast(copies) if few else copies
        rows = rows.withColumn("tag", F.shiftright("at", 44)).alias("m")
        return rows.join(gone.alias("c"), _same("m", "c"), "left_anti").drop("tag")

    # anchors that occur again
    anchors = marked.mapInArrow(_anchored, "key long, segment long, doc_id long, at long")
    if few:  # no shuffle, so it pays to do it first
        anchors = without_copies(anchors)
    again = anchors.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    again = scratch.save(again, "again")  # so that the join can split hot keys
    found = anchors.join(again, "key", "left_semi")
    found = scratch.save(found if few else without_copies(found), "found")

    # equal segments, all but the first
    firsts = scratch.save(_firsts(found, ["key", "segment"]), "firsts")
    equal = scratch.save(_later(found, firsts, ["key", "segment"]), "equal")
    scratch.drop("found", "texts")

    # different segments of one anchor
    several = scratch.save(_several(firsts), "several")
    wanted = firsts.join(several, "key").select("key", "f.doc_id", "f.at", F.shiftright("f.at", 44).alias("tag"))
    wanted = wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "at")).alias("wanted"))
    pieces = marked.alias("m").join(wanted.alias("w"), _same("m", "w")).select("m.*", "wanted")
    pieces = scratch.save(pieces.mapInArrow(_cut_out, PIECES), "pieces")
    scratch.drop("firsts")

    # large anchors are divided until none is left: blocks of one string leave groups of one segment
    spans, small, division = copies.unionByName(equal), None, 0
    while True:
        some = pieces.join(several.where(F.col("n") <= MOST).select("key"), "key", "left_semi")
        small = some if small is None else small.unionByName(some)
        large = several.where(F.col("n") > MOST).select("key")
        if large.isEmpty():
            break
        division += 1
        rows = pieces.join(large, "key", "left_semi")
        rows = rows.mapInArrow(_divided(BLOCKS[division - 1]), "key long, segment long, doc_id long, at long, body binary")
        rows = scratch.save(rows, f"divided_{division}")
        firsts = rows.groupBy("key", "segment").agg(_first(), F.count("*").alias("times"), F.first("body").alias("body"))
        firsts = scratch.save(firsts, f"firsts_{division}")
        spans = spans.unionByName(_later(rows.drop("body"), firsts, ["key", "segment"]))
        several = scratch.save(_several(firsts), f"several_{division}")
        pieces = firsts.join(several, "key").select("key", "f.doc_id", "f.at", "body")
        pieces = scratch.save(pieces, f"pieces_{division}")
    small = small.repartition("key").sortWithinPartitions("key")
    spans = spans.unionByName(small.mapInArrow(_by_suffix_array, "doc_id long, tag long, start long, end long"))
    spans = scratch.save(spans, "spans")
    scratch.keep("spans")
    return spans


def _several(firsts: DataFrame) -> DataFrame:
    """The keys of more than one segment, and how many those are."""
    return firsts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")


def _without(text: str, spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text, PART_BYTES):
                out: dict[str, list] = {name: [] for name in (*RESULT, "kept_sha256")}
                data, starts = as_bytes(part.column(text))
                for row, gone in enumerate(part.column(spans).to_pylist()):
                    whole = data[starts[row] : starts[row + 1]]
                    removed, n = 0, 0
                    if gone:
                        edge = np.zeros(len(whole) + 1, np.int64)
                        ends = np.array([(x["start"], x["end"]) for x in gone])
                        np.add.at(edge, ends[:, 0], 1)
                        np.add.at(edge, ends[:, 1], -1)
                        covered = np.cumsum(edge[:-1]) > 0
                        removed = int(covered.sum())
                        n = int(covered[0]) + int(np.sum(covered[1:] & ~covered[:-1]))
                        whole = whole[~covered]
                    kept = whole.tobytes()
                    values = (kept, int(starts[row + 1] - starts[row]), removed, n)
                    for name, value in zip(out, (*values, hashlib.sha256(kept).hexdigest()), strict=True):
                        out[name].append(value)
                columns = [
                    *part.columns[:-1],
                    pa.array(out["kept"], pa.binary()),
                    *(pa.array(out[name], pa.int64()) for name in RESULT[1:]),
                    pa.array(out["kept_sha256"], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], *out])

    return run


def repeats_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with kept (the remaining bytes), n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, doc_id, text)
    names = [free_name(docs, c) for c in ("gone_id", "gone_tag", "gone_spans")]
    gone = spans.groupBy(F.col("doc_id").alias(names[0]), F.col("tag").alias(names[1]))
    gone = gone.agg(F.collect_list(F.struct("start", "end")).alias(names[2]))
    tag = _tag(F.coalesce(F.col(text), F.lit("")))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(names[0])) & (tag == F.col(names[1]))
    kept = [c for c in docs.columns if c.lower() not in (*RESULT, "kept_sha256")]
    joined = docs.join(gone, same, "left").select(*kept, names[2])
    schema = joined.drop(names[2]).schema
    for name, kind in zip((*RESULT, "kept_sha256"), ("binary", "long", "long", "long", "string")):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_without(text, names[2]), schema)
