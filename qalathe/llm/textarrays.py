"""Texts of an Arrow batch as one byte array: words, their hashes and sums per text, without loops over texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1_000_000
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with at most so many bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes.astype(np.int64)), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and the bounds of each text in them; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def words(
    data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = BLANK,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word, a run of bytes that are not ``blank``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~blank[data]
    first, last = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # A text begins and ends its own words.
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    cut = cuts[inside[cuts] & inside[cuts + 1]]
    first[cut], last[cut] = True, True
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return start, end, np.searchsorted(bounds, start, "right") - 1


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULTIPLIER, -1, 2**64)
    return tuple(
        np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, m, np.uint64), dtype=np.uint64)])
        for m in (_MULTIPLIER, inverse))


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, by differences of one running sum."""
    n = len(data)
    up, down = _powers(max(n, SLICE_BYTES) if n <= SLICE_BYTES else 1 << (n - 1).bit_length())
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[:n], dtype=np.uint64, out=running[1:])
    length = (end - start).astype(np.uint64)
    return mixed((running[end] - running[start]) * down[start] + length)


def distinct_counts(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many distinct 64-bit values each of ``n`` owners has, up to hash collisions of 64 bits less its number."""
    bits = np.uint64(max(n, 2).bit_length())
    keys = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[new] >> (np.uint64(64) - bits)).astype(np.int64), minlength=n)


def span_texts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of each span as a text."""
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    at = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at]))
