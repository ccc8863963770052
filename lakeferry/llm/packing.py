"""Packing: documents become windows of equal length, by sum-of-squares placement.

A document is its token ids and the end id. Whole windows are cut off a document
that is longer than one; what is left, shorter than a window, is placed at once:
into a partially filled window of the fill level, or into a new window, that
makes the sum of the squared counts of partially filled windows by level least.
The counts stand in an array by level, so a placement looks at levels, not at
windows. Of equal levels the fullest is taken.

Placement alone leaves windows open, and any number of them for some sizes (all
documents a little over half a window, say). So when `OPEN` windows are open,
and at the end of a partition, windows are poured: pieces of the emptiest are cut
to fill the gaps of the fullest, until half are left, at the end one. What that
last one holds is cut into sequences whose lengths are powers of two, which need
no padding. So there is no padding at all, and cuts are few: those of
documents longer than a window, and those of poured windows.

Each partition is packed by itself, in the order of its rows; nothing is
shuffled. A task holds the open windows and one part of the texts. Of a table
read from files, a task that runs again packs the same rows in the same order.
Sequences are numbered by partition (its number times 2**32 and a count).

Tokens are those of a tokenizer file for the `tokenizers` library, without its
special tokens: their names in a text are ordinary text. Byte-level tokenizers
never have a token across the edge from a character to white space behind it, or
from a letter to a stop behind it, so texts are cut there, and each Python worker
keeps the ids of such units: those of the last `REMEMBER` to `2 * REMEMBER`.

Defined results: null and empty texts are the end id alone; rows that repeat a
doc_id are documents of their own, as are equal rows; a null doc_id is kept; an
empty table gives an empty result. The result has the columns stated, none of the table's
besides the document's number.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeferry.llm.token_counts import byte_letters
from lakeferry.llm.words import parts

WINDOW = 2048
END_ID = 1
#: so many windows may be open in a task
OPEN = 1024
PART_BYTES = 1 << 20
#: units whose ids a worker keeps, each of so many characters at most
REMEMBER, UNIT_CHARS = 400_000, 64
#: pieces that make an output batch
BATCH_PIECES = 1024

# Letters beyond doubt. A token ends behind a run of them, if what follows is in ASCII and no letter.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_WORD = rf" ?[{_LETTERS}]++(?![^ \n\r\t!-@\[-`{{-~])"
# Of white space, the last space goes with what follows, and any other last one is alone.
_UNITS = re.compile(rf"{_WORD}| ?[^ \n\r\t]++|[ \n\r\t]+(?![^ \n\r\t])|[\n\r\t]")
_ALONE = re.compile(f" ?[{_LETTERS}]+")
_OTHER_SPACE = re.compile(r"[^\S \n\r\t]")
_EDGE = re.compile(r"(?<=\S)(?=[ \n\r\t])")


def units(text: str) -> list[str]:
    """The text in pieces that can be tokenized one by one."""
    if _OTHER_SPACE.search(text):
        return _EDGE.split(text)
    return _UNITS.findall(text)


class Units(dict):
    """The ids of units, little-endian unsigned 32-bit, found out when they are asked for."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            found = self._made(unit)
        if len(unit) <= UNIT_CHARS:
            self[unit] = found
        return found

    def _made(self, unit: str) -> bytes:
        if _ALONE.fullmatch(unit):  # the model merges it as it is
            if unit.isascii():
                spelt = self.letters[0x20] + unit[1:] if unit[0] == " " else unit
            else:
                spelt = unit.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.model.tokenize(spelt)]
        else:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def forget(self) -> None:
        """Keep no more than so many, those asked for last."""
        if len(self) > REMEMBER:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Texts to ids, the end id behind each."""

    def __init__(self, tokenizer: str, end_id: int = END_ID) -> None:
        reader = Tokenizer.from_str(tokenizer)
        reader.encode_special_tokens = True
        self.units = Units(reader)
        self.end = array("I", [end_id]).tobytes()

    def ids(self, texts: Iterable[str]) -> list[np.ndarray]:
        found = [b"".join(map(self.units.__getitem__, units(text))) for text in texts]
        self.units.forget()
        return [np.frombuffer(one + self.end, "<u4") for one in found]


@functools.lru_cache(1)
def _encoder(tokenizer: str, end_id: int) -> Encoder:
    """One for all tasks of a worker, which run one after another."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores have tasks of their own
    return Encoder(tokenizer, end_id)


class Piece:
    """Some ids of a document: the document's row, where they start, and the ids."""

    __slots__ = ("doc", "start", "ids")

    def __init__(self, doc: tuple, start: int, ids: np.ndarray) -> None:
        self.doc, self.start, self.ids = doc, start, ids

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:size]), Piece(
            self.doc, self.start + size, self.ids[size:]
        )


class Window:
    """A partially filled window."""

    __slots__ = ("pieces", "fill")

    def __init__(self) -> None:
        self.pieces: list[Piece] = []
        self.fill = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)

    def take(self, most: int) -> Piece:
        """The last piece, or its first ids, if it has more than `most`."""
        piece = self.pieces.pop()
        if len(piece.ids) > most:
            piece, rest = piece.cut(most)
            self.pieces.append(rest)
        self.fill -= len(piece.ids)
        return piece


def best_level(counts: np.ndarray, size: int) -> int:
    """The fill level whose window a piece should go to; 0 is a new window.

    `counts` has the number of open windows by level, from 0 to the window's
    length; both ends are 0. Moving a window from h to h + size changes the sum of
    squares by 2 * (counts[h + size] - counts[h]) + 2, one less where a window is
    opened or closed.
    """
    last = len(counts) - 1 - size
    cost = counts[size:] - counts[: last + 1]
    cost *= 2
    cost[1:last] += 2
    cost[0] += 1
    if last:
        cost[last] += 1
    none = counts[: last + 1] == 0
    none[0] = False
    cost[none] = np.iinfo(np.int64).max
    return last - int(np.argmin(cost[::-1]))


class Packer:
    """Documents in, closed sequences out (through `close`, a list of pieces at a time)."""

    def __init__(self, close: Callable[[list[Piece]], None], window: int = WINDOW, most: int = OPEN) -> None:
        self.close, self.window, self.most = close, window, most
        self.counts = np.zeros(window + 1, np.int64)
        self.levels: list[list[Window]] = [[] for _ in range(window + 1)]
        self.open = 0

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.close([Piece(doc, start, ids[start : start + self.window])])
        if whole == len(ids):
            return
        piece = Piece(doc, whole, ids[whole:].copy())  # the document's other ids may go
        level = best_level(self.counts, len(piece.ids))
        if level:
            target = self.levels[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            target = Window()
        target.add(piece)
        self._hold(target)
        if self.open >= self.most:
            self._pour(self.most // 2)

    def _hold(self, target: Window) -> None:
        if target.fill == self.window:
            self.close(target.pieces)
        elif target.fill:
            self.levels[target.fill].append(target)
            self.counts[target.fill] += 1
            self.open += 1

    def _pour(self, left: int) -> None:
        """Fill the fullest windows from the emptiest, until so many are open."""
        windows = [one for level in self.levels for one in level]
        first, last = 0, len(windows) - 1
        while last - first >= left and first < last:
            empty, full = windows[first], windows[last]
            full.add(empty.take(self.window - full.fill))
            if full.fill == self.window:
                self.close(full.pieces)
                last -= 1
            if not empty.fill:
                first += 1
        self.levels = [[] for _ in range(self.window + 1)]
        self.counts[:], self.open = 0, 0
        for one in windows[first : last + 1]:
            self._hold(one)

    def end(self) -> None:
        """Close all windows. The last one goes as sequences of powers of two."""
        self._pour(1)
        for level in self.levels:
            for one in level:
                one.pieces.reverse()
                while one.fill:
                    size = 1 << (one.fill.bit_length() - 1)
                    sequence = []
                    while size:
                        sequence.append(one.take(size))
                        size -= len(sequence[-1].ids)
                    self.close(sequence)


SCHEMA = (
    "start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def packed(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of all documents, and the place of each in a sequence.

    `tokenizer` is the content of a tokenizer file. Columns: the document's number,
    start (ids of the document before the piece), length, ids (little-endian
    unsigned 32-bit), ids_crc32 (of these bytes), doc_tokens (ids of the document,
    with the end id), sequence_id and offset (of the piece in its sequence).
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = _encoder(sent.value, end_id), TaskContext.get().partitionId() << 32
        out: list[tuple] = []

        def close(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for piece in pieces:
                body, size = piece.ids.tobytes(), len(piece.ids)
                number, tokens = piece.doc
                out.append((number, piece.start, size, body, zlib.crc32(body), tokens, sequence, offset))
                offset += size
            sequence += 1

        def flushed(least: int) -> Iterator[pa.RecordBatch]:
            while len(out) >= least:
                some, out[:BATCH_PIECES] = out[:BATCH_PIECES], []
                columns = [pa.array(c, t) for c, t in zip(zip(*some), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        packer = Packer(close, window)
        for batch in batches:
            number_type = batch.schema.field("doc_id").type
            types = [number_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 4]
            for part in parts(batch, "text", PART_BYTES):
                ids = encoder.ids(part.column("text").to_pylist())
                for number, one in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    packer.add((number, len(one)), one)
                    yield from flushed(BATCH_PIECES)
        packer.end()
        yield from flushed(1)

    names = ["doc_id", *[field.split()[0] for field in SCHEMA.split(", ")]]
    found = rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
    return found.withColumnRenamed("doc_id", doc_id)
