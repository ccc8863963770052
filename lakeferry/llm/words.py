"""Words and hashes of whole Arrow text columns, by numpy inside tasks.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` of the UTF-8 bytes, with A-Z in
lower case first: ASCII letters and digits, and every character beyond ASCII.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = (
    ((LOWER >= 0x30) & (LOWER <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (LOWER >= 0x80)
)

_ODD = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_ODD)) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


#: so many powers are kept (16 bytes each); more are made anew each time
KEPT_POWERS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the step and of its inverse, modulo 2**64."""
    if len(_powers["up"]) >= n:
        return _powers["up"][:n], _powers["down"][:n]
    made = []
    for step in (_STEP, _BACK):
        table = np.full(n, step, np.uint64)
        table[0] = 1
        made.append(np.cumprod(table, dtype=np.uint64))
    if n <= KEPT_POWERS:
        _powers["up"], _powers["down"] = made
    return made[0], made[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """c so that (c[e] - c[s]) * down[s] is a hash of data[s:e] wherever it stands.

    Sums modulo 2**64 tell apart what is no longer than some hundred bytes, and serve
    to find candidates; there are longer strings that differ and have equal sums whatever
    the step, so these hashes do not tell whether long strings are equal.
    """
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[: len(data)], out=sums[1:])
    return sums


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each row starts.

    Null is empty. The second array has one entry more than the column has rows.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def parts(
    batch: pa.RecordBatch, text: str, limit: int, row_bytes: int = 0
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most so many bytes of text, or one longer row.

    `row_bytes` is what a row takes besides its text.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64) + row_bytes)
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        after = max(row + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(row, after - row)
        row = after


def word_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of some texts begins and ends in their bytes."""
    inside = IN_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    begin = np.flatnonzero(inside & (~before | first[:-1]))
    return begin, np.flatnonzero(inside & (~after | first[1:])) + 1


#: words of more bytes are hashed one by one
LONG_WORD = 64


def each_folded(
    data: np.ndarray,
    begin: np.ndarray,
    end: np.ndarray,
    state: np.ndarray,
    step: Callable[[np.ndarray, np.ndarray], np.ndarray],
    long_: Callable[[bytes], int],
) -> np.ndarray:
    """`step(state, byte)` over the bytes of each string, all strings a byte at a time.

    `state` has the first state of each; what `long_` gives for strings of over `LONG_WORD` bytes.
    """
    size = np.minimum(end - begin, LONG_WORD + 1).astype(np.uint8)
    order = np.argsort(size, kind="stable")[::-1]
    at, state = begin[order], state[order]
    longer = np.cumsum(np.bincount(size, minlength=LONG_WORD + 2)[::-1])[::-1]
    for k in range(LONG_WORD):
        n = longer[k + 1]
        if not n:
            break
        state[:n] = step(state[:n], data[at[:n] + k])
    out = np.empty_like(state)
    out[order] = state
    for n in np.flatnonzero(size > LONG_WORD):
        out[n] = long_(data[begin[n] : end[n]].tobytes())
    return out


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    state = (state ^ _CODES[byte]) * np.uint64(0xBF58476D1CE4E5B9)
    return state ^ (state >> np.uint64(29))


def string_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings of any length, that differ where the strings do."""
    first = mix((end - begin).astype(np.uint64) + np.uint64(1))
    long_ = lambda x: int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little")
    return mix(each_folded(data, begin, end, first, _step, long_))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def crc32s(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC-32 of each string."""
    step = lambda state, byte: _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))
    first = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    return ~each_folded(data, begin, end, first, step, lambda x: zlib.crc32(x) ^ 0xFFFFFFFF)


class Words:
    """The words of some texts: hash, text number, and place in the bytes of each."""

    def __init__(self, column: pa.Array) -> None:
        data, self.starts = as_bytes(column)
        self.texts = len(column)
        self.begin, self.end = word_places(data, self.starts)
        self.hash = string_hashes(LOWER[data], self.begin, self.end)
        self.text = np.searchsorted(self.starts, self.begin, "right") - 1
        #: of each text, where its words begin among all; one entry more than texts
        self.bounds = np.searchsorted(self.text, np.arange(self.texts + 1))

    def __len__(self) -> int:
        return len(self.hash)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `width` words, and the text of each.

        A text of fewer words, but not none, has one shingle of all its words.
        """
        n = len(self)
        up, _ = powers(width + 1)
        counts = np.diff(self.bounds)
        if n >= width:
            rolled = np.zeros(n - width + 1, np.uint64)
            for k in range(width):
                rolled += self.hash[k : n - width + 1 + k] * up[k]
            whole = self.text[: n - width + 1] == self.text[width - 1 :]
            hashes, texts = mix(rolled[whole]), self.text[: n - width + 1][whole]
        else:
            hashes, texts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            own = [
                np.sum(self.hash[self.bounds[t] : self.bounds[t + 1]] * up[: counts[t]])
                for t in short
            ]
            own = np.array(own, np.uint64) + counts[short].astype(np.uint64) * np.uint64(_ODD)
            hashes = np.concatenate((hashes, mix(own)))
            texts = np.concatenate((texts, short))
            order = np.argsort(texts, kind="stable")
            hashes, texts = hashes[order], texts[order]
        return hashes, texts
