"""Texts of Arrow batches as one byte array, for work that is vectorised over many documents at once."""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
BLOCK_BYTES = 4_000_000


def blocks(batches: Iterator[pa.RecordBatch], text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``block_bytes`` of text, or a single longer one; null becomes empty."""
    for batch in batches:
        column = batch.column(text).fill_null("").cast(pa.large_string())
        batch = batch.set_column(batch.schema.get_field_index(text), text, column)
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        first = 0
        while first < len(column):
            last = int(np.searchsorted(ends, ends[first] + block_bytes, side="right")) - 1
            last = min(max(last, first + 1), len(column))
            yield batch.slice(first, last - first)
            first = last


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a large-string column without nulls, and where each text begins and ends."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def times(a: np.uint64, k: int) -> np.uint64:
    """a times k, modulo 2^64; numpy warns of overflow where both are scalars."""
    return np.uint64(int(a) * k & 0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Any fixed odd multiplier; its inverse modulo 2^64 takes a place out of a rolling sum again.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: A value for each byte, so that sums over bytes do not keep the structure of the bytes.
VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the powers 0 to n-1, modulo 2^64."""
    return _table(base)[:n] if n <= KEPT_POWERS else _powers(base, n)


KEPT_POWERS = 1 << 19


@lru_cache
def _table(base: np.uint64) -> np.ndarray:
    return _powers(base, KEPT_POWERS)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def range_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range ``data[first:last]``; it depends on the bytes alone."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    back = powers(BASE_INVERSE, len(data) + 1)
    return mixed((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))


def word_ranges(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and the index of its text. Words are runs without ASCII white space."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return first, last, np.searchsorted(ends, first, side="right") - 1


def shingle_hashes(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each run of ``size`` words, and the index of its text; ascending by text.

    A text with words, but fewer than ``size``, is one shorter run. A text without words has none.
    """
    data, ends = bytes_of(column)
    first, last, owner = word_ranges(data, ends)
    words = range_hashes(data, first, last)
    n = len(words)
    total = np.zeros(n, np.uint64)
    whole = np.ones(n, bool)
    for k in range(size):
        same = np.zeros(n, bool)
        same[: n - k] = owner[k:] == owner[: n - k]
        step = np.zeros(n, np.uint64)
        step[: n - k] = words[k:]
        total = np.where(same, mixed(total * BASE + step), total)
        whole &= same
    begins = np.ones(n, bool)
    begins[1:] = owner[1:] != owner[:-1]
    short = begins & ~whole
    use = whole | short
    return total[use], owner[use]
