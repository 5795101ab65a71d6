"""Files that each hold one JSON document, read by split.

Spark reads a JSON document with ``multiLine`` in one task per file. Here a file is read as pieces
cut at every comma, which the text reader splits like lines, and the items of the arrays at a given
depth are found by the state of the text before each piece: inside a string or not, and the
nesting depth. A comma can never follow a backslash in JSON, so no escape is open at a cut.

1. Each split is walked in its own task from either string state at its start, with depths
   relative to the start: what state it ends in, how the depth moves, and where items start and
   end at each relative depth. That is one small row per split.
2. The driver composes those rows in file order, one per split as in the plan of the scan, and
   gives each split its true start: string state, depth, and the item open there.
3. Each split is walked again from its start. Items that lie wholly in it are parsed there; only
   an item that crosses a split border leaves in parts, and the parts meet by a shuffle of those
   parts alone. Text outside the items (the document without them) is gathered per file the same
   way, so that fields beside the array can be read.

Items are parsed by ``from_json`` with the given schema, as the ``multiLine`` reader does with
each record. Bytes that are no UTF-8 become U+FFFD. An empty file or array gives no items; an
item of white space alone is none. Items of arrays at the depth that lie inside other values at a
smaller depth than ``depth - 1`` are not told apart from those of the wanted array.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import split_runs
from .split_csv import saved

_IN_STRING = re.compile(rb'(?:[^"\\]|\\.)*"', re.S)
_STRUCTURE = re.compile(rb'["\[\]{}]')
# Characters of items a task gathers at most before it hands them on.
HELD_CHARS = 4 << 20
_SUMMARY = "file string, block long, summary string"
_ITEMS = "file string, block long, piece long, at long, kb long, kp long, ka long, whole boolean, item string"


def _pieces(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"))


def walk(pieces, in_string: bool, depth: int, first: int = 0):
    """Events of pieces from a start state: ("open" | "sep" | "close", piece, offset, depth).

    ``open`` is a ``[`` that enters a depth, ``sep`` a cut at it outside strings, ``close`` the
    ``]`` that leaves it; depths are as reached from ``depth``, pieces are counted from ``first``.
    Returns (events, in_string, depth).
    """
    events = []
    for k, piece in enumerate(pieces, first):
        i, n = 0, len(piece)
        while i < n:
            if in_string:
                m = _IN_STRING.match(piece, i)
                if m is None:
                    i = n
                    break
                i, in_string = m.end(), False
                continue
            m = _STRUCTURE.search(piece, i)
            if m is None:
                break
            c, i = piece[m.start()], m.end()
            if c == 0x22:
                in_string = True
            elif c in (0x5B, 0x7B):
                depth += 1
                if c == 0x5B:
                    events.append(("open", k, m.end(), depth))
            else:
                if c == 0x5D:
                    events.append(("close", k, m.start(), depth))
                depth -= 1
        if not in_string:
            events.append(("sep", k, n, depth))
    return events, in_string, depth


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for (f, b), pieces in split_runs(batches, "piece"):
        state = {s: (s, 0) for s in (False, True)}
        # Per string state and relative depth: the last item start and whether an end follows it.
        last: dict[bool, dict[int, list]] = {False: {}, True: {}}
        for k, piece in enumerate(pieces):
            for s, found in last.items():
                events, *state[s] = walk((piece,), *state[s], k)
                for kind, _, at, d in events:
                    if kind == "open":
                        found[d] = [k, at, False]
                    elif kind == "sep":
                        found[d] = [k + 1, 0, False]
                    else:
                        found[d] = [None, None, True]
        rows.append((f, b, json.dumps({
            str(int(s)): {"end_string": state[s][0], "delta": state[s][1],
                          "last": {str(d): v for d, v in found.items()}}
            for s, found in last.items()})))
    if rows:
        f, b, s = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(b, pa.int64()),
                                          pa.array(s, pa.string())], names=["file", "block", "summary"])


def compose(rows, item_depth: int) -> dict:
    """(file, block) -> (in_string, depth, open item key or None, last split of the file) at the
    start of each split."""
    out, by_file = {}, {}
    for f, b, summary in rows:
        by_file.setdefault(f, []).append((b, json.loads(summary)))
    for f, splits in by_file.items():
        in_string, depth, open_item = False, 0, None
        splits.sort()
        for n, (b, summary) in enumerate(splits):
            out[(f, b)] = (in_string, depth, open_item, n + 1 == len(splits))
            mine = summary[str(int(in_string))]
            found = mine["last"].get(str(item_depth - depth))
            if found is not None:
                open_item = None if found[2] else (b, found[0], found[1])
            in_string, depth = mine["end_string"], depth + mine["delta"]
    return out


class _Span:
    """Text from a place in a split up to where the walk is: the pieces between, and no more."""

    def __init__(self, piece: int, at: int):
        self.start, self.parts = (piece, at), []

    def rest(self, k: int, piece: bytes, at: int) -> bytes:
        return piece[self.start[1] if k == self.start[0] else 0:at]

    def hold(self, k: int, piece: bytes) -> None:
        if k >= self.start[0]:
            self.parts.append(self.rest(k, piece, len(piece)))

    def text(self, *last: bytes) -> str:
        return b",".join([*self.parts, *last]).decode("utf-8", errors="replace")


def _split_parts(f, b, pieces, in_string, depth, open_item, last_split, item_depth):
    """The rows of one split: items whole or in parts, and the text outside them."""
    key = open_item
    item, outside = _Span(0, 0), None if open_item else _Span(0, 0)
    k, following = -1, next(pieces, None)
    while following is not None:
        k, piece, following = k + 1, following, next(pieces, None)
        events, in_string, depth = walk((piece,), in_string, depth, k)
        for kind, _, at, d in events:
            if d != item_depth or (kind == "sep" and following is None and key is None):
                continue  # other depths; the comma after the split's last piece, outside the items
            if key is not None:  # an item ends here
                yield (f, b, *item.start, *key, key[0] == b, item.text(item.rest(k, piece, at)))
            elif kind == "open" and outside is not None:
                yield (f, b, *outside.start, -1, -1, -1, False, outside.text(outside.rest(k, piece, at)))
            if kind == "close":
                key, outside = None, _Span(k, at)
            elif kind == "open":
                key, item, outside = (b, k, at), _Span(k, at), None
            else:
                key, item = (b, k + 1, 0), _Span(k + 1, 0)
        if key is not None:
            item.hold(k, piece)
        if outside is not None:
            outside.hold(k, piece)
    if key is not None and item.start[0] <= k:
        yield (f, b, *item.start, *key, False, item.text())
    elif key is None and outside is not None and k >= 0:
        yield (f, b, *outside.start, -1, -1, -1, False, outside.text() + ("" if last_split else ","))


def assemble(states, item_depth: int):
    """Task function: items whole or in parts, and the text outside them, from each split's start.

    Parts outside the items carry the comma that follows them where the split ends before the
    file does, so that they join without a separator. A task holds the item it is in and the rows
    it has not handed on, not its split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = states.value
        out, held = [], 0
        for (f, b), pieces in split_runs(batches, "piece"):
            for row in _split_parts(f, b, pieces, *table[(f, b)], item_depth):
                out.append(row)
                held += len(row[-1])
                if len(out) >= 2048 or held >= HELD_CHARS:
                    yield _batch(out)
                    out, held = [], 0
        if out:
            yield _batch(out)
    return run


def _batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(),
             pa.string()]
    names = ["file", "block", "piece", "at", "kb", "kp", "ka", "whole", "item"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _texts(spark: SparkSession, path, item_depth: int) -> tuple[DataFrame, DataFrame]:
    """(file, kb, kp, ka, item): the items that lie wholly in a split, and the texts put together
    from parts: items over split borders, and with ``kb`` = -1 the text outside the items."""
    summaries = _pieces(spark, path).mapInArrow(summarise, _SUMMARY)
    # Collected at once: a local iterator would run the splits one after another.
    states = spark.sparkContext.broadcast(compose(summaries.collect(), item_depth))
    parts = _pieces(spark, path).mapInArrow(assemble(states, item_depth), _ITEMS)
    whole = parts.where("whole AND kb >= 0").select("file", "kb", "kp", "ka", "item")
    # The parts are few: written once, the items and the text outside both read them.
    joined = (
        saved(parts.where("NOT whole"), "json-parts").groupBy("file", "kb", "kp", "ka")
        .agg(F.sort_array(F.collect_list(F.struct("block", "piece", "at", "item"))).alias("p"))
        .select("file", "kb", "kp", "ka", F.when(F.col("kb") < 0, F.array_join("p.item", "")).otherwise(F.array_join("p.item", ",")).alias("item")))
    return whole, joined


def item_texts(spark: SparkSession, path, item_depth: int = 1) -> DataFrame:
    """(file, kb, kp, ka, item): the text of every item at ``item_depth``, and with ``kb`` = -1 the
    text outside the items of each file, in parts in file order."""
    whole, joined = _texts(spark, path, item_depth)
    return whole.unionByName(joined).where((F.col("kb") < 0) | (F.trim(F.col("item")) != ""))


def read_json_items(
    spark: SparkSession, path, schema: T.StructType, item_depth: int = 1, outside: Column | None = None,
) -> DataFrame:
    """The items of one JSON array per file (at ``item_depth``), parsed by ``schema``, with their
    place in the file as ``_pos`` and the text outside the items as ``_outside``.

    ``outside``, an expression over that text, stands for it where a short value is all that is
    wanted: it is taken once per file and goes to the items without a shuffle of them, as one row
    per file, as many as the driver holds already to plan the scan."""
    whole, joined = _texts(spark, path, item_depth)
    around = joined.where("kb < 0").select("file", F.col("item").alias("_outside"))
    if outside is not None:
        around = F.broadcast(around.select("file", outside.alias("_outside")))
    texts = whole.unionByName(joined.where("kb >= 0")).where(F.trim(F.col("item")) != "")
    items = texts.select(
        "file", F.from_json("item", schema).alias("r"), F.struct("file", "kb", "kp", "ka").alias("_pos"))
    return items.join(around, "file", "left").select("r.*", "_pos", "_outside")
