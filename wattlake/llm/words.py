"""Words, word hashes and rolling window hashes of whole Arrow batches at once.

A word is a run of bytes outside ``0x20`` and ``0x09-0x0D``; UTF-8 keeps those bytes out of
longer characters, so the work is done on bytes.  Hashes are polynomial (Rabin-Karp) modulo
2**64 over random-looking values and scrambled at the end, which makes them equal on every
executor and in every run.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes looked at together; bounds the memory of a task, whatever a batch holds.
SLICE_BYTES = 1 << 20

FIRST_BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD6E8FEB86659FD93


def release_memory() -> None:
    """Give freed memory back to the machine: a worker outlives its tasks, and several share an
    executor's allowance."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(function: Callable) -> Callable:
    """The function of a group, with :func:`release_memory` after it."""

    def run(table):
        try:
            return function(table)
        finally:
            release_memory()

    return run


def releasing_pair(function: Callable) -> Callable:
    """The same for the function of a pair of groups."""

    def run(left, right):
        try:
            return function(left, right)
        finally:
            release_memory()

    return run


def scrambled(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes stay."""
    capital = (data >= 65) & (data <= 90)
    return data + (capital * np.uint8(32)).astype(np.uint8)


class Words(NamedTuple):
    """Bytes of some texts and the words in them; text d has words bounds[d] to bounds[d + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, content = filled.buffers()
    offsets = np.frombuffer(places, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if content is None:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    data = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def separators(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, none across a text's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    begin = offsets[:-1][offsets[:-1] < len(inside)]
    opens[begin] = inside[begin]
    end = offsets[1:][offsets[1:] > 0] - 1
    closes[end] = inside[end]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(~separators(data), offsets)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count + 1, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, out=powers)


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from prefix sums."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values))[:-1], out=prefix[1:])
    back = _powers(pow(base, -1, 1 << 64), len(values))
    return (prefix[ends] - prefix[starts]) * back[starts]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    values = scrambled(np.arange(1, 257, dtype=np.uint64))[data]
    length = (ends - starts).astype(np.uint64)
    return scrambled(_rolling(values, starts, ends, FIRST_BASE) + length)


class Windows(NamedTuple):
    """Every window of a fixed number of words: its hash, its first word and its text."""

    hashes: np.ndarray
    first: np.ndarray
    text: np.ndarray


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int, base: int = FIRST_BASE) -> Windows:
    """Rabin-Karp hashes of all windows of ``size`` words that lie within one text."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.arange(len(hashes))
    inside = first + size <= bounds[1:][text]
    first, text = first[inside], text[inside]
    return Windows(scrambled(_rolling(hashes, first, first + size, base)), first, text)


def covered(first: np.ndarray, size: int, words: int) -> np.ndarray:
    """Which words lie in one of the windows that begin at ``first``."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    return np.cumsum(change[:-1]) > 0


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of a flag or count over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def sliced(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text; a longer text is a piece alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0)
    # 32 bytes a row, so that a million empty texts are not one piece
    total = np.cumsum(np.asarray(sizes, np.int64) + 32)
    begin = 0
    while begin < batch.num_rows:
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end
