"""Texts of Arrow batches as numpy arrays: bytes, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def slices(column: pa.Array, most_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each; a longer text is a range of its own."""
    sizes = np.asarray(pc.binary_length(column).fill_null(0), dtype=np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if total and total + size > most_bytes:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: empty), and len + 1 offsets into them."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes that are no white space."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    space, edges = IS_SPACE[data], offsets[:-1][offsets[:-1] < len(data)]
    first, last = np.empty(len(data), bool), np.empty(len(data), bool)
    first[0] = last[-1] = True
    first[1:], last[:-1] = space[:-1], space[1:]
    first[edges] = True
    last[edges[edges > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & first), np.flatnonzero(~space & last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def rising(base):
        found = np.full(size, base, np.uint64)
        found[0] = 1
        return np.multiply.accumulate(found)
    return rising(BASE), rising(pow(BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The running sum of powers over the bytes, and the powers' inverses."""
    powers, inverse = _powers(1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=sums[1:])
    return sums, inverse


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running sum of powers."""
    sums, inverse = _sums(data)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """:func:`span_hashes` of the ``size`` bytes from each byte on that has so many, without looking up each place."""
    sums, inverse = _sums(data)
    return mix((sums[size:] - sums[:-size]) * inverse[:len(data) - size + 1] + np.uint64(size))
