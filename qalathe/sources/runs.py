"""The rows of a task's input split by split, as the text reader deals them out."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa


def _keyed(batches: Iterator[pa.RecordBatch], column: str):
    for batch in batches:
        files = batch.column("file").dictionary_encode()
        names = files.dictionary.to_pylist()
        for f, b, value in zip(files.indices.to_pylist(), batch.column("block").to_pylist(),
                               batch.column(column).to_pylist()):
            yield (names[f], b), value or b""


def split_runs(batches: Iterator[pa.RecordBatch], column: str):
    """((file, block), values) for each run of one split; the values come as they are read, so a
    task never holds a split."""
    for key, rows in groupby(_keyed(batches, column), itemgetter(0)):
        yield key, (value for _, value in rows)
