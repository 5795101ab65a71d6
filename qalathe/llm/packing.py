"""Packing of token pieces into sequences of fixed capacity by exact complements.

Only how many pieces of each length there are decides the packing, so the plan is made from that
histogram, at most ``capacity`` numbers. The lengths of singles, pairs and triples are looked up
by their sum: a combination that fills a gap exactly is used as often as its lengths are there.
Best fit places the rest. Pieces then find their place by their rank among those of equal length.

Defined cases. A null or empty text is its end token alone. A longer document is cut; only its
first piece may be shorter than the capacity. Rows with a repeated or null id are documents of
their own, told apart by nothing but their rows. Other columns never matter. An empty table gives
an empty table.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .work import lean, saved

CAPACITY = 1024


# --- the plan ---------------------------------------------------------------------------

def _exact_fill(left: np.ndarray, gap: int, parts: int) -> tuple[int, ...] | None:
    """That many available lengths with the sum ``gap``; of pairs, those that are there most often."""
    if parts == 1:
        return (gap,) if left[gap] > 0 else None
    if parts == 2:
        a = np.arange(1, gap // 2 + 1)
        if not len(a):
            return None
        uses = np.where(a == gap - a, left[a] // 2, np.minimum(left[a], left[gap - a]))
        best = int(uses.argmax())
        return (int(a[best]), gap - int(a[best])) if uses[best] > 0 else None
    for a in np.flatnonzero(left[:max(gap - 1, 0)] > 0)[::-1].tolist():
        left[a] -= 1
        found = _exact_fill(left, gap - a, 2)
        left[a] += 1
        if found:
            return (a, *found)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal bins: (number of bins, [(length, pieces of that length in each)]).

    Exact fills by one, two and three pieces come first, and best fit after them; where lengths
    are so spread that fewer kinds of exact fills need fewer bins, only those are used.
    """
    return min((_plan(histogram, capacity, parts) for parts in (3, 2, 1, 0)), key=lambda g: sum(n for n, _ in g))


def _plan(histogram: dict[int, int], capacity: int, most_parts: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Each step uses up a length or fills a group of bins, so the number of groups depends on the
    capacity and not on the number of pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    groups = []
    if left[capacity]:
        groups.append((int(left[capacity]), [(capacity, 1)]))
        left[capacity] = 0
    for parts, length in itertools.product(range(1, most_parts + 1), range(capacity - 1, 0, -1)):
        while left[length] > 0:
            left[length] -= 1
            fill = _exact_fill(left, capacity - length, parts)
            left[length] += 1
            if fill is None:
                break
            each = Counter((length, *fill))
            bins = min(int(left[x]) // m for x, m in each.items())
            for x, m in each.items():
                left[x] -= bins * m
            groups.append((bins, sorted(each.items(), reverse=True)))

    # Best fit, longest first, for what no exact combination takes. Open bins by their gap.
    open_bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)

    def put(bins: int, content: list[tuple[int, int]], gap: int) -> None:
        if bins:
            (open_bins[gap] if gap else groups).append((bins, content))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = next((g for g in range(length, capacity) if open_bins.get(g)), None)
            bins, content, gap = (*open_bins[gap].pop(), gap) if gap else (n, [], capacity)
            most = gap // length
            full = min(bins, n // most)
            rest = min(n - full * most, most) if bins > full else 0
            put(full, [*content, (length, most)], gap - most * length)
            if rest:
                put(1, [*content, (length, rest)], gap - rest * length)
            if content:
                put(bins - full - bool(rest), content, gap)
            n -= full * most + rest
    return groups + [x for found in open_bins.values() for x in found]


def _slots(groups: list[tuple[int, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
    """Ranges of ranks per length, with the first sequence and the offset they go to."""
    used, rows, base = Counter(), [], 0
    for bins, content in groups:
        offset = 0
        for length, copies in content:
            for _ in range(copies):
                rows.append((length, used[length], base, offset))
                used[length] += bins
                offset += length
        base += bins
    table = np.array(sorted(rows) or [(0, 0, 0, 0)], np.int64)
    return (table[:, 0] << 48) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]


# --- the tables -------------------------------------------------------------------------

def cut_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
    text: str = "text", doc_id: str = "doc_id", with_ids: bool = True,
) -> DataFrame:
    """Token pieces: id, piece, start, length, ``ids_crc32``, ids, and the place in their task.

    ``__task`` and ``__nth`` count the pieces of one length within a task; they are fixed once the
    table is written.
    """
    base = docs.select(doc_id, text)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, task = bpe.unit_encoder(bpe.file_tokenizer, path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for part in itertools.chain.from_iterable(bpe.chunks(p, text) for p in lean(parts)):
            ids, bounds = run(part.column(text))
            # The end token behind each text.
            ids, bounds = np.insert(ids, bounds[1:], end_id).astype("<u4"), bounds + np.arange(len(bounds))
            sizes = np.diff(bounds)
            n_pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            # Pieces end at whole capacities counted from the end of their document.
            stop = sizes[doc] - capacity * (n_pieces[doc] - 1 - piece)
            start = np.maximum(stop - capacity, 0)
            length, first = stop - start, bounds[doc] + start
            sums = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(first.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [
                part.column(0).take(pa.array(doc)), *(pa.array(x, pa.int32()) for x in (piece,)),
                *(pa.array(x, pa.int64()) for x in (start, length, sums)),
                pa.array(np.full(len(doc), task), pa.int32()), pa.array(nth, pa.int64())]
            names = [doc_id, "piece", "start", "length", "ids_crc32", "__task", "__nth"]
            if with_ids:
                cuts = np.concatenate([first, bounds[-1:]])
                columns.append(pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32), pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = base.select(doc_id).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"),
                       ("__task", "integer"), ("__nth", "long")):
        schema = schema.add(name, kind)
    return base.mapInArrow(batches, schema.add("ids", T.ArrayType(T.IntegerType())) if with_ids else schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces``, a written table of :func:`cut_pieces`, with ``sequence_id`` and ``offset``."""
    per_task = pieces.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__task")) - F.col("__n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys, since, base, offset = _slots(plan(counts, capacity))
    ranked = (
        pieces.join(per_task.select("length", "__task", before.alias("__before")), ["length", "__task"])
        .withColumn("__rank", F.col("__before") + F.col("__nth"))
        .drop("__task", "__nth", "__before").select(*[c for c in pieces.columns if c[:2] != "__"], "__rank")
    )

    # A function of two numbers, so that the ids of the pieces stay out of the Python workers.
    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        length, rank = length.to_numpy(), rank.to_numpy()
        slot = np.searchsorted(keys, (length << 48) + rank, "right") - 1
        found = [pa.array(base[slot] + rank - since[slot]), pa.array(offset[slot])]
        return pa.StructArray.from_arrays(found, ["sequence_id", "offset"])

    names = ranked.drop("__rank").columns
    return ranked.select(*names, place("length", "__rank").alias("__place")).select(
        *names, "__place.sequence_id", "__place.offset")


def packed_documents(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
    text: str = "text", doc_id: str = "doc_id", with_ids: bool = True,
) -> DataFrame:
    """All pieces of ``docs`` with their sequence and their place in it."""
    return pack(saved(cut_pieces(docs, path, end_id, capacity, text, doc_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in a row; a sequence holds at most its capacity of them."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
        .alias("ids"))
