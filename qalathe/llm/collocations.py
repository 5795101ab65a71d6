"""Phrase collocations: phrases of 2 to 5 words that occur together more than their parts predict.

A phrase is frequent only if the phrases of one word less at both its ends are. So for m = 1 to 5
words a sketch is summed: a task hashes its windows whose two ends passed the level below, and sends
how many fell to each bucket, in ranges of 2^16 buckets (3 bytes a bucket that is hit); Spark brings
the counts of a range together, and the buckets that reach the threshold are the bitmap of the level.
No text is built or moved for this. A bucket holds at least the occurrences of each of its phrases,
so the bitmaps lose none; their size follows from the bytes of text, at most ``MAX_BITS`` bits.

The windows that pass the bitmaps are then counted as texts, exactly, in one pass over all levels: a
task counts the windows of some texts by phrase (vectorised) and gathers those counts in a HAT-trie of
Arrow containers: a shallow level deals phrases by the hash of their first word into
``FANOUT`` containers, a container that grows past ``BURST`` rows bursts (is merged by phrase),
and when the task holds more than ``SPILL`` rows, all containers are merged; if still half as many
distinct phrases are left, they leave as sorted runs. A task sends each of its phrases once, so
this pass has ``TASKS_PER_CORE`` tasks a core and no more for a larger table: what is sent grows with
the phrases, not with phrases times tasks. Spark
merges the runs by phrase with map-side combining, so a frequent first word is no hot key. A false
hit in a bitmap costs a counted phrase, never a missed one. The documents are read once for each pass.

Scores: a = f(phrase), n = word occurrences of the part; a cut after k words has
l = f(first k), r = f(rest) and score floor(1000 a n / (l r)), computed in 38-digit decimals.
The lowest score counts, ties to the smallest k. A candidate is dropped when its words lie
contiguously inside a longer candidate with f(longer) >= a.

Defined cases. A null text is empty, a null part is ``und``. Only A-Z are lower-cased. Pieces are
cut at ``[.,;:!?\\x0A-\\x0D]``; words are runs of other characters than space and tab, so phrases
never cross a piece. Repeated rows count again. Texts of any length are split whole. Parts with no
candidate give no rows; an empty table gives no rows. Other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textarrays as ta
from .work import saved, slots

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
FANOUT = 256
BURST = 200_000
SPILL = 2_000_000
# Counting tasks for each core.
TASKS_PER_CORE = 2
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
# Bytes of text for one bucket of a sketch, buckets of a range, windows hashed or counted at once.
BUCKET_BYTES = 16
RANGE_BITS = 16
HASHED_AT_ONCE = 4_000_000
COUNTED_AT_ONCE = 400_000

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = _CUT.copy()
_BLANK[[0x20, 0x09]] = True
_RUN = "part string, phrase string, f long"
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit values, the same in every task."""
    with np.errstate(over="ignore"):
        x = (a ^ (b * _C1)) * _C2
        x ^= x >> np.uint64(31)
        x *= _C3
        return x ^ (x >> np.uint64(29))


class Words:
    """The words of some texts: their bytes, pieces, parts and hashes."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, bounds = ta.text_bytes(batch.column("text"))
        self.data = ta.LOWER[data]
        self.start, self.end, self.doc = ta.words(self.data, bounds, _BLANK)
        # Grows with each cut and each text, so it names the piece of a word.
        self.piece = np.cumsum(_CUT[self.data])[self.start] + self.doc
        self.hashes = ta.span_hashes(self.data, self.start, self.end)
        self.part_hash = batch.column("part_hash").to_numpy(zero_copy_only=False).view(np.uint64)

    def windows(self, bitmaps: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first words, hashes) of the windows of 1 to ``most`` words.

        Where a level has a bitmap, its windows are those the bitmap holds; windows of the level
        above have two of them as their ends.
        """
        at, level = np.arange(len(self.start)), mix(self.part_hash[self.doc], self.hashes)
        for m in range(1, most + 1):
            if m > 1:
                # The window that begins one word later passed too, and ends in the same piece.
                both = np.flatnonzero(at[1:] == at[:-1] + 1)
                both = both[self.piece[at[both]] == self.piece[at[both] + m - 1]]
                at, level = at[both], mix(level[both], self.hashes[at[both] + m - 1])
            if m <= len(bitmaps):
                held = _held(bitmaps[m - 1], level)
                at, level = at[held], level[held]
            yield at, level


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


class HatCounter:
    """Counts of phrases in a HAT-trie of Arrow containers.

    The shallow trie level deals phrases by the hash of their first word into ``FANOUT``
    containers. A container collects counted rows; past ``BURST`` rows it bursts, that is, it
    is merged by (part, phrase) into one table. Past ``SPILL`` rows in all containers, every
    container is merged; if more than half of ``SPILL`` are left, each leaves as a run sorted by
    (part, phrase) and the trie starts empty.
    """

    def __init__(self, m: int) -> None:
        self.m = m
        self.containers: list[list[pa.Table]] = [[] for _ in range(FANOUT)]
        self.rows = np.zeros(FANOUT, dtype=np.int64)

    def add(self, counted: pa.Table, first: np.ndarray) -> None:
        """Rows (part, phrase, f) with the 64-bit hash of each phrase's first word."""
        bucket = (first % np.uint64(FANOUT)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(FANOUT + 1))
        for k in np.flatnonzero(np.diff(bounds)):
            rows = counted.take(pa.array(order[bounds[k]:bounds[k + 1]]))
            self.containers[k].append(rows)
            self.rows[k] += rows.num_rows
            if self.rows[k] > BURST:
                self.containers[k] = [_merged(self.containers[k])]
                self.rows[k] = self.containers[k][0].num_rows

    def runs(self, everything: bool) -> Iterator[pa.Table]:
        """All containers as sorted runs, once too many distinct rows are held or at the end."""
        if not everything and self.rows.sum() <= SPILL:
            return
        for k in range(FANOUT):
            if self.containers[k]:
                self.containers[k] = [_merged(self.containers[k])]
                self.rows[k] = self.containers[k][0].num_rows
        if not everything and self.rows.sum() <= SPILL // 2:
            return
        for k in range(FANOUT):
            if self.containers[k]:
                yield self.containers[k][0].sort_by([("part", "ascending"), ("phrase", "ascending")])
        self.containers = [[] for _ in range(FANOUT)]
        self.rows[:] = 0


def _merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables)
    return both.group_by(["part", "phrase"]).aggregate([("f", "sum")]).rename_columns(["part", "phrase", "f"])


def _bucket_rows(places: np.ndarray, least: int, dtype) -> pa.RecordBatch:
    """(range, buckets, counts) of the places hit; a count ends at ``least``."""
    place, n = np.unique(places, return_counts=True)
    part = place >> np.uint64(RANGE_BITS)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    bounds = np.append(first, len(place))

    def blobs(values):
        offsets = (bounds * values.itemsize).astype(np.int32)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])

    return pa.RecordBatch.from_arrays(
        [pa.array(part[first].astype(np.int64)), blobs(place.astype(np.uint16)),
         blobs(np.minimum(n, least).astype(dtype))], ["range", "buckets", "counts"])


def _bitmap(table: DataFrame, m: int, bitmaps: list, bits: int, least: int) -> np.ndarray:
    """The buckets that hold at least ``least`` windows of m words, as a bitmap of ``bits`` bits."""
    dtype = next(t for t in (np.uint8, np.uint16, np.uint64) if least <= np.iinfo(t).max)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [b.value for b in bitmaps]
        held, rows = [], 0
        for batch in batches:
            for piece in ta.slices(batch, "text"):
                *_, (_, level) = Words(piece).windows(known, m)
                held.append(level & np.uint64(bits - 1))
                rows += len(level)
                if rows >= HASHED_AT_ONCE:
                    yield _bucket_rows(np.concatenate(held), least, dtype)
                    held, rows = [], 0
        if rows:
            yield _bucket_rows(np.concatenate(held), least, dtype)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges come one after the other.
        last, counts = None, None

        def row():
            full = np.packbits(counts >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([full], pa.binary())], ["range", "bits"])

        for batch in batches:
            for k, buckets, n in zip(*(batch.column(c) for c in ("range", "buckets", "counts"))):
                if k.as_py() != last:
                    if last is not None:
                        yield row()
                    last, counts = k.as_py(), np.zeros(1 << RANGE_BITS, np.int64)
                counts[np.frombuffer(buckets.as_py(), np.uint16)] += np.frombuffer(n.as_py(), dtype).astype(np.int64)
        if last is not None:
            yield row()

    hits = table.mapInArrow(hit, "range long, buckets binary, counts binary")
    found = hits.repartition(slots(table.sparkSession), "range").sortWithinPartitions("range").mapInArrow(
        reached, "range long, bits binary").toArrow()
    bitmap = np.zeros((bits >> RANGE_BITS, 1 << (RANGE_BITS - 3)), np.uint8)
    for k, full in zip(found.column("range").to_pylist(), found.column("bits").to_pylist()):
        bitmap[k] = np.frombuffer(full, np.uint8)
    return bitmap.reshape(-1)


def _counted(parts: list, phrases: list, first: list) -> tuple[pa.Table, np.ndarray]:
    found = pa.table({"part": pa.concat_arrays(parts), "phrase": pa.concat_arrays(phrases),
                      "first": pa.array(np.concatenate(first).view(np.int64))})
    counted = found.group_by(["part", "phrase", "first"]).aggregate([([], "count_all")])
    return (pa.table({"part": counted.column("part"), "phrase": counted.column("phrase"),
                      "f": counted.column("count_all")}), counted.column("first").to_numpy().view(np.uint64))


def count_phrases(bitmaps: list):
    """Task function: (part, phrase, f) of the windows that the broadcast bitmaps of all levels let
    pass, and rows without a phrase that hold the numbers of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [b.value for b in bitmaps]
        counter = HatCounter(len(known))
        held, rows = ([], [], []), 0

        def emit(everything):
            for run in counter.runs(everything):
                yield pa.RecordBatch.from_arrays(
                    [run.column(c).combine_chunks().cast(t) for c, t in
                     (("part", pa.string()), ("phrase", pa.string()), ("f", pa.int64()))], names=["part", "phrase", "f"])

        for batch in batches:
            for piece in ta.slices(batch, "text"):
                words, part = Words(piece), piece.column("part").cast(pa.large_string())
                texts = ta.span_texts(words.data, words.start, words.end)
                total = pa.table({"part": part.take(pa.array(words.doc))}).group_by("part").aggregate([([], "count_all")])
                yield pa.RecordBatch.from_arrays(
                    [total.column("part").combine_chunks().cast(pa.string()), pa.nulls(total.num_rows, pa.string()),
                     total.column("count_all").combine_chunks()], names=["part", "phrase", "f"])
                for m, (at, _) in enumerate(words.windows(known, len(known)), 1):
                    if not len(at):
                        break
                    joined = [texts.take(pa.array(at + j)) for j in range(m)]
                    held[0].append(part.take(pa.array(words.doc[at])))
                    held[1].append(pc.binary_join_element_wise(*joined, pa.scalar(" ", pa.large_string())) if m > 1 else joined[0])
                    held[2].append(words.hashes[at])
                    rows += len(at)
                # The windows of some texts are counted first, vectorised; the trie takes distinct phrases.
                if rows >= COUNTED_AT_ONCE:
                    counter.add(*_counted(*held))
                    held, rows = ([], [], []), 0
                    yield from emit(False)
        if rows:
            counter.add(*_counted(*held))
        yield from emit(True)
    return run


def phrase_counts(docs: DataFrame, text: str = "text", part: str = "lang", min_count: int = MIN_COUNT):
    """(part, m, phrase, f) of every phrase of 1 to 5 words with f >= ``min_count``, and
    (part, n) word occurrences per part. Both are of one work table."""
    spark = docs.sparkSession
    table = docs.select(F.coalesce(F.col(part).cast("string"), F.lit("und")).alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("part_hash", F.xxhash64("part"))
    size = table.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = MIN_BITS
    while bits * BUCKET_BYTES < size and bits < MAX_BITS:
        bits *= 2
    bitmaps = []
    for m in range(1, MAX_WORDS + 1):
        bitmaps.append(spark.sparkContext.broadcast(_bitmap(table, m, bitmaps, bits, min_count)))
    counts = saved(
        table.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism).mapInArrow(count_phrases(bitmaps), _RUN).groupBy("part", "phrase").agg(F.sum("f").cast("long").alias("f"))
        .where(F.col("phrase").isNull() | (F.col("f") >= min_count)), "phrases")
    for bitmap in bitmaps:
        bitmap.unpersist()
    frequent = counts.where(F.col("phrase").isNotNull()).select(
        "part", F.size(F.split("phrase", " ")).alias("m"), "phrase", "f")
    return frequent, counts.where(F.col("phrase").isNull()).select("part", F.col("f").alias("n"))


def collocations(docs: DataFrame, text: str = "text", part: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` phrases of each part."""
    frequent, totals = phrase_counts(docs, text, part, min_count)
    f = frequent.select("part", "phrase", "f")
    cand = frequent.where(F.col("m") >= 2).select("part", "phrase", "m", F.col("f").alias("a"),
                                                 F.split("phrase", " ").alias("ws"))
    cuts = cand.select("part", "phrase", "m", "a", "ws", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select(
        "part", "phrase", "a", "k",
        F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("lp"),
        F.array_join(F.slice("ws", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rp"))
    scored = (
        cuts.join(f.withColumnRenamed("phrase", "lp").withColumnRenamed("f", "l"), ["part", "lp"])
        .join(f.withColumnRenamed("phrase", "rp").withColumnRenamed("f", "r"), ["part", "rp"])
        .join(totals, "part")
        .withColumn("score", F.expr(
            "CAST((CAST(1000 AS DECIMAL(38,0)) * a * n) DIV (CAST(l AS DECIMAL(38,0)) * r) AS BIGINT)")))
    best = scored.groupBy("part", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b")).select("part", "phrase", "a", "n", "b.*")
    longer = cand.where(F.col("m") >= 3).select(
        "part", "a", "ws", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("len"))
    inner = longer.select(
        "part", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - F.col("len") + 1),
                                           lambda i: F.array_join(F.slice("ws", i, F.col("len")), " "))).alias("phrase")
    ).groupBy("part", "phrase").agg(F.max("a").alias("outer"))
    kept = best.join(inner, ["part", "phrase"], "left").where(F.col("outer").isNull() | (F.col("outer") < F.col("a")))
    order = Window.partitionBy("part").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select(F.col("part").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase",
                F.col("a").cast("long").alias("a"), F.col("l").cast("long").alias("l"),
                F.col("r").cast("long").alias("r"), "n", "score"))
