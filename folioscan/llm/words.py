"""Words and word shingles of a whole Arrow text column at once.

The bytes of many texts are cut into words with array operations, and every word and shingle gets a
64-bit hash. Nothing here knows Spark; the operators call it inside their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 18
# Rows of a column whose bytes are copied at once.
CHUNK_ROWS = 256
_ODD = 0x9E3779B97F4A7C15
_SPACE = [0x20, *range(0x09, 0x0E)]


def space_words() -> np.ndarray:
    """By byte: its place in a word, or 0 where words end. Words are runs without ASCII white space."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[_SPACE] = 0
    return table


def plain_words() -> np.ndarray:
    """Words are runs of letters, digits and non-ASCII characters; ASCII case is folded."""
    table = np.zeros(256, dtype=np.uint16)
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalnum():
            table[byte] = ord(chr(byte).lower()) + 1 if byte < 0x80 else byte + 1
    return table


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


@dataclass
class Words:
    """Words of some consecutive rows; ``first[i]:first[i + 1]`` are those of row ``i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """``(hash, row)`` of every run of ``size`` words; a shorter text is one shingle."""
        n = len(self.start)
        at, last = np.arange(n), self.first[self.row + 1]
        total, factor = np.zeros(n, dtype=np.uint64), 1
        for step in range(size):
            inside = at + step < last
            total += np.where(inside, self.hash[np.minimum(at + step, n - 1)], np.uint64(0)) * np.uint64(factor)
            factor = factor * _ODD % 2**64
        keep = (last - at >= size) | (at == self.first[self.row])
        return mixed(total[keep]), self.row[keep]


def powers(base: int, size: int) -> np.ndarray:
    """``base ** 0``, ``base ** 1`` and so on, modulo 2 ** 64."""
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class WordReader:
    """Cuts text columns into ``Words``; keeps the powers that the hashes need."""

    def __init__(self, table: np.ndarray):
        self.table = table
        values = np.random.default_rng(7).integers(0, 2**63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.values = values[table.astype(np.int64)]
        self._grow(CHUNK_BYTES)

    def _grow(self, size: int) -> None:
        self.power, self.inverse = (powers(base, size + 1) for base in (_ODD, pow(_ODD, -1, 2**64)))

    def read(self, texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
        """``(low, high, words)`` for consecutive row ranges of the column; null reads as empty."""
        for first in range(0, len(texts), CHUNK_ROWS):
            data, offsets = text_bytes(texts.slice(first, CHUNK_ROWS))
            for low, high in ranges(offsets):
                bounds = offsets[low : high + 1] - offsets[low]
                yield first + low, first + high, self._words(data[offsets[low] : offsets[high]], bounds)

    def _words(self, data: np.ndarray, bounds: np.ndarray) -> Words:
        size = len(data)
        inside = self.table[data] > 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = bounds[1:] > bounds[:-1]
        heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
        begins[heads], ends[tails] = inside[heads], inside[tails]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if size >= len(self.power):
            self._grow(size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.power[:size], out=sums[1:])
        value = mixed((sums[end] - sums[start]) * self.inverse[start])
        row = np.searchsorted(bounds, start, "right") - 1
        first = np.searchsorted(start, bounds, "left")
        return Words(data, start, end, row, first, value)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what a task builds from a batch of texts stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the offsets of its rows; null reads as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets


def ranges(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, rows)
        yield low, high
        low = high


def distinct_per_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, their rows, and how often each occurs. ``rows`` ascends."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return values[at], rows[at], np.diff(np.append(at, len(values)))


def repeats_per_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, times)`` of each row's distinct values, told apart by 40 bits or more of their hashes.

    For statistics: one plain sort instead of ``distinct_per_row``'s order of two columns.
    """
    bits = np.uint64(min(24, int(rows[-1]).bit_length()) if len(rows) else 0)
    packed = (rows.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits) if bits else values.copy()
    packed.sort()
    new = np.ones(len(packed), dtype=bool)
    new[1:] = packed[1:] != packed[:-1]
    at = np.flatnonzero(new)
    owner = (packed[at] >> (np.uint64(64) - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
    return owner, np.diff(np.append(at, len(packed)))


def per_row(values: np.ndarray, bounds: np.ndarray, reduce: np.ufunc, empty) -> np.ndarray:
    """``reduce`` over ``values[bounds[i]:bounds[i + 1]]``; ``empty`` where there are none."""
    out = np.full((len(bounds) - 1, *values.shape[1:]), empty, dtype=values.dtype)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        out[filled] = reduce.reduceat(values, bounds[:-1][filled])
    return out
