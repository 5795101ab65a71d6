"""Which of many phrases occur in each text of a column, found in one pass over the bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes looked through at once, so that the positions of one pass stay small.
SLICE_BYTES = 4 << 20


def _slices(starts: np.ndarray):
    """Runs of rows of about ``SLICE_BYTES``, each of at least one row."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE_BYTES, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def phrases_found(texts: pa.Array, phrases: list[bytes]) -> np.ndarray:
    """A row per text and a column per phrase: whether the phrase's bytes occur in the text.

    Places are sought by their first two bytes for all phrases at once, then by each phrase's rest,
    so the cost hardly depends on the number of phrases. Null texts hold no phrase.
    """
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    out = np.zeros((n, len(phrases)), bool)
    if not n:
        return out
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    if texts.buffers()[2] is None:
        data = np.zeros(0, np.uint8)
    else:
        data = np.frombuffer(texts.buffers()[2], np.uint8)
    present = np.asarray(texts.is_valid())
    by_pair: dict[int, list[int]] = {}
    for j, p in enumerate(phrases):
        if len(p) > 1:
            by_pair.setdefault(p[0] | p[1] << 8, []).append(j)
    wanted = np.zeros(65536, bool)
    wanted[list(by_pair)] = True
    for first, last in _slices(starts):
        low, high = int(starts[first]), int(starts[last])
        here = data[low:high]
        if len(here) > 1:
            pairs = here[:-1] | here[1:].astype(np.uint16) << 8
            places = np.flatnonzero(wanted[pairs])
            pairs = pairs[places]
        else:
            places = pairs = np.zeros(0, np.int64)
        ends = starts[first + 1:last + 1] - low
        for pair, members in by_pair.items():
            found = places[pairs == pair]
            for j in members:
                p, at = phrases[j], found[found <= len(here) - len(phrases[j])]
                for k in range(2, len(p)):
                    at = at[here[at + k] == p[k]]
                row = np.searchsorted(ends, at, "right")
                out[first + row[at + len(p) <= ends[row]], j] = True
        for j, p in enumerate(phrases):
            if len(p) == 1:
                out[first + np.searchsorted(ends, np.flatnonzero(here == p[0]), "right"), j] = True
    for j, p in enumerate(phrases):
        if not p:
            out[:, j] = present
    return out & present[:, None]
