"""Texts of Arrow batches as flat byte arrays, and their words as hashed arrays.

A batch of texts is one buffer of UTF-8 bytes with an offset per row. Word borders, word hashes and
hashes of word runs are found for a whole buffer at a time, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text handled at a time; a longer single text is handled alone.
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over the 256 byte values: true inside the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Words between white space: everything but space and the control characters 9 to 13.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# Words of digits, lower or upper case ASCII letters and all that is not ASCII.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A 64-bit value per byte; A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


_VALUES = _byte_values()
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for factor in (_BASE, inverse):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of some texts in order. ``first`` has a border per text: words first[i] to first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)
    offsets = offsets[column.offset :]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    column: pa.Array, limit: int = BLOCK_BYTES, most_rows: int = 1 << 30
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows low to high with their bytes and offsets, about ``limit`` bytes and at most ``most_rows`` rows at a time."""
    if not len(column):
        return
    data, offsets = texts_of(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), low + most_rows, rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def split_words(data: np.ndarray, offsets: np.ndarray, inside_word: np.ndarray) -> Words:
    """Longest runs of word bytes, none of them across two texts."""
    inside = inside_word[data]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    begins[borders] = inside[borders]
    finishes[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """A 64-bit hash for each byte span, with A-Z read as a-z; equal spans have equal hashes anywhere."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def run_hashes(hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the text of each.

    A text of fewer words, but not none, has one run: all its words.
    """
    counts = words.counts
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    text = words.text_of_word()
    place = np.arange(len(hashes)) - words.first[text]
    full = np.flatnonzero(place + size <= counts[text])
    sums = np.zeros(len(full), dtype=np.uint64)
    for k in range(size):
        sums += hashes[full + k] * factors[k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    lone = np.zeros(len(short), dtype=np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        lone[has] += hashes[words.first[short[has]] + k] * factors[k]
    lone += counts[short].astype(np.uint64) * factors[size - 1]
    return mix(np.concatenate([sums, lone])), np.concatenate([text[full], short])


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the two columns an operator reads, so that other columns of any name do no harm."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
