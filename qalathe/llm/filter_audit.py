"""How five document filters interact, in every order: counts per step from a mask per document.

Filters A to D look at one text and are column expressions. Filter E, "the same text as a row with
a smaller id", is decided by radix tries over the full UTF-8 bytes of the texts:

1. Each input task sorts its rows by text and id and inserts them into a compressed trie; the
   first id at a terminal is its smallest, every later row with a larger id fails E right there.
   Those rows go on without their text, so a text that a third of the table holds is one row per
   task from here on.
2. The rest is range-partitioned by a text prefix and a hash of the whole text. Spark samples
   the bounds, so ranges adapt to the texts: a prefix that many texts share is split by the hash,
   and equal texts always meet in one range. Each range is sorted and inserted into a trie again.

Texts arrive sorted, so an insertion only touches the trie's right-most path; a subtree left of
that path is complete, is traversed for its terminals and let go. Memory is the current path,
not the range. The failures of a document are a 5-bit mask; masks are counted per part and the
counts are expanded to the 120 orders, which is no more than 32 masks a part.

Defined cases. A null text is empty. Words are maximal runs of non-blanks, case-sensitive; a text
without words fails A and passes B (no words, none repeated). C compares ``[A-Z]`` with all code
points, so an empty text passes it. Rows with a null id never fail E and make no other row fail
it; rows equal in id and text fail E together or not at all. A null ``lang`` is the part ``''``.
Labels count a document as good (toxic) if any label row of its id says so; a document without
labels is neither. Every row is a document, repeated ones too. Other columns never matter, also
where their names clash with the ones used here. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import saved

LETTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = "[#$%&*|]"
# Bytes of the prefix in the range key; longer shared prefixes are split by the hash beside it.
PREFIX_BYTES = 32

_BLANKS = r"[\x20\x09-\x0D]+"
_FLAGS_DDL = "id long, key binary, repeat boolean, part string, mask int, n long"
_FLAGS = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("repeat", pa.bool_()),
                    ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def _lcp(a: bytes, b: bytes) -> int:
    """Length of the common prefix, compared in slices of growing size."""
    end, lo, step = min(len(a), len(b)), 0, 64
    while lo < end:
        hi = min(lo + step, end)
        if a[lo:hi] != b[lo:hi]:
            return next(i for i in range(lo, hi) if a[i] != b[i])
        lo, step = hi, step * 2
    return end


class SortedTrie:
    """A compressed trie fed keys in ascending order, ids ascending within a key (nulls last).

    ``path`` is the right-most path as (string depth, smallest id at the terminal or None for a
    branching node). Nodes left of it are complete and are not kept: nothing sorted later can
    reach them. A row repeats when its id is larger than the smallest id of its terminal.
    """

    def __init__(self) -> None:
        self.path: list[tuple[int, object]] = [(0, None)]
        self.last: bytes | None = None
        self.terminals = 0

    def insert(self, key: bytes, row_id) -> bool:
        if key == self.last:
            smallest = self.path[-1][1]
            return row_id is not None and smallest is not None and row_id > smallest
        shared = 0 if self.last is None else _lcp(self.last, key)
        while self.path[-1][0] > shared:
            self.path.pop()
        if self.path[-1][0] < shared:
            self.path.append((shared, None))  # where the new key branches off the path
        self.path.append((len(key), row_id))
        self.last = key
        self.terminals += 1
        return False


def flag_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, id nulls last), with ``repeat`` set where a smaller id holds the key.

    Rows without a key pass as they are. Rows that repeat leave without their key. Consecutive
    rows equal in key, id, part and mask leave as one row with their number in ``n``, so that
    rows repeated whole shrink to one row a batch.
    """
    trie = SortedTrie()
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("id").to_pylist()
        before, ns = batch.column("repeat").to_pylist(), batch.column("n").to_pylist()
        parts, masks = batch.column("part").to_pylist(), batch.column("mask").to_pylist()
        keep, flags, counts, last = [], [], [], None
        for i, key in enumerate(keys):
            repeat = bool(before[i]) or (key is not None and trie.insert(key, ids[i]))
            this = (key, ids[i], parts[i], masks[i], repeat)
            if key is not None and this == last:
                counts[-1] += ns[i]
                continue
            last = this
            keep.append(i)
            flags.append(repeat)
            counts.append(ns[i])
        rows = batch.take(pa.array(keep, pa.int64()))
        flag = pa.array(flags, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), pc.if_else(flag, pa.nulls(len(flags), pa.binary()), rows.column("key")),
             flag, rows.column("part"), rows.column("mask"), pa.array(counts, pa.int64())], schema=_FLAGS)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANKS), lambda w: w != "")


def filter_masks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """(id, part, n, mask): ``n`` rows whose bit k is set where the document fails filter ``LETTERS[k]``."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        t.cast("binary").alias("key"), _words(t).alias("w"),
        F.length(F.regexp_replace(t, "[^A-Z]", "")).alias("upper"), F.length(t).alias("cp"), t.rlike(SYMBOLS).alias("d"))
    n = F.size("w")
    mask = (
        F.when(n < MIN_WORDS, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct("w")) < DISTINCT_PERCENT * n, 2).otherwise(0)
        + F.when(100 * F.col("upper") > UPPER_PERCENT * F.col("cp"), 4).otherwise(0)
        + F.when(F.col("d"), 8).otherwise(0))
    # Written once: the range partitioner samples its input, which would run this pass again.
    local = saved(
        rows.select("id", "key", F.lit(False).alias("repeat"), "part", mask.cast("int").alias("mask"),
                    F.lit(1).cast("long").alias("n"))
        .sortWithinPartitions("key", F.col("id").asc_nulls_last(), "part", "mask")
        .mapInArrow(flag_repeats, _FLAGS_DDL), "local-repeats")
    # Equal texts meet by prefix and hash of the whole text; rows that repeat are spread by id.
    spread = F.when(F.col("key").isNull(), F.xxhash64("id", "part", "mask")).otherwise(F.xxhash64("key"))
    ranged = (
        local.repartitionByRange(F.substring("key", 1, PREFIX_BYTES), spread)
        .sortWithinPartitions("key", F.col("id").asc_nulls_last(), "part", "mask")
        .mapInArrow(flag_repeats, _FLAGS_DDL))
    return ranged.select("id", "part", "n", (F.col("mask") + F.when(F.col("repeat"), 16).otherwise(0)).alias("mask"))


def _steps() -> Column:
    """(order, step, bit, earlier) for each step of each of the 120 orders."""
    rows = []
    for order in ("".join(p) for p in permutations(LETTERS)):
        for step, letter in enumerate(order, 1):
            earlier = sum(1 << LETTERS.index(c) for c in order[:step - 1])
            rows.append(F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"),
                                 F.lit(1 << LETTERS.index(letter)).alias("bit"), F.lit(earlier).alias("earlier")))
    return F.explode(F.array(*rows))


def filter_audit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang",
) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, all counts of documents (long), zeros included."""
    judged = (
        labels.where(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("long").alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    masks = filter_masks(docs, text, doc_id, part).join(judged, "id", "left")
    counts = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("g"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("x"))
    s = counts.select("*", _steps().alias("s")).select("part", "mask", "n", "g", "x", "s.*")
    fails = (F.col("mask").bitwiseAND(F.col("bit")) != 0)
    before = (F.col("mask").bitwiseAND(F.col("earlier")) != 0)
    removed = fails & ~before

    def total(cond: Column, of: str = "n") -> Column:
        return F.sum(F.when(cond, F.col(of)).otherwise(0)).cast("long")

    out = s.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~before).alias("kept"), total(removed).alias("removed"),
        total(fails & before).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed, "g").alias("good_lost"), total(removed, "x").alias("toxic_lost"))
    shapley = out.groupBy("part", "bit").agg(F.sum("removed").cast("long").alias("shapley"))
    return out.join(shapley, ["part", "bit"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant",
        "unique_fails", "good_lost", "toxic_lost", "shapley")
