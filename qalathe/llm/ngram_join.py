"""Self-join of documents on the Jaccard similarity of their word n-grams, by partition and pigeonhole.

Sets of n-grams that are similar enough differ in few elements. The elements are dealt by hash into
more segments than such a pair may have differences, so at least one segment is equal in both. The
number of segments depends on the size band of the smaller set, which is indexed there by all its
segments; the larger set probes its own band and the one below. A probe does not need all its
segments: it takes the cheapest, by how many documents hold them, and where too few are cheap, it
takes two for one by the one-deletion neighbourhoods of a segment. What meets is verified on the
sets in full.

Documents of equal sets are linked with the smallest id among them, which alone goes on: the others
are left out by a filter of the ids that stay. What it lets through all the same finds no sketch later.

Links that are implied are not looked for: in each bucket all members meet one of them first, and
only pairs that this leaves in different components are verified as well.

Defined cases. A null or empty text, or one of blanks, has no n-grams and no links; its component is
its own id. A text of fewer words is one n-gram of all its words. Rows with a null id take part in
nothing and have a null component. Rows with one id are one document for the links: what one of
them is linked with, all are. Other columns do not matter. An empty table gives an empty table.

N-grams are compared as 52-bit hashes. For a wrong verdict an n-gram of one set must collide with
one of the other, less than one in 10^9 for sets of 1,000, and the pair must lie one n-gram from
the threshold. Equal sets are told by 128 bits of hash over their n-grams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .components import components
from .work import forget, saved, slots

# Ratio of the sizes at the ends of a band.
BAND_RATIO = 1.5
# Documents whose segments tell the cost of a segment, and how many of them make it a dear one.
COST_SAMPLE = 20_000
DEAR = 4
# One in so many segments is indexed with its one-deletion neighbourhood.
NEIGHBOURHOODS = 16
# Documents of one slice: their number and the hash of an n-gram share 64 bits.
SLICE_ROWS = 4000
_ROW_BITS = np.uint64(12)

# 64-bit words of the sketch that tells most unlike sets apart where they meet.
SKETCH_WORDS = 8
PAIRS_AT_ONCE = 100

# Bits of a filter of ids for each of them, and at least and most.
BITS_PER_ID = 8
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28

INDEX, PROBE = 1, 2


# --- sets of n-grams ----------------------------------------------------------------------

def ngram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text in rising order, and the bounds of each text in them.

    Hashes are cut to 52 bits here, so that one sort of numbers orders texts and hashes.
    """
    data, bounds = ta.text_bytes(texts)
    data = ta.LOWER[data]
    start, end, doc = ta.words(data, bounds)
    word = ta.span_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    count = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(count) - count

    def joined(at: np.ndarray, size: int) -> np.ndarray:
        total = np.full(len(at), size, np.uint64)
        for k in range(size):
            total = ta.mixed(total * np.uint64(0x9E3779B97F4A7C15) + word[at + k])
        return total

    whole = np.arange(len(word)) + n <= (first + count)[doc] if len(word) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    owners, hashes = [doc[at]], [joined(at, n)]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        owners.append(short)
        hashes.append(joined(first[short], size))
    owner, value = np.concatenate(owners).astype(np.uint64), np.concatenate(hashes)
    keys = np.sort((owner << (np.uint64(64) - _ROW_BITS)) | (value >> _ROW_BITS))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    owner = (keys >> (np.uint64(64) - _ROW_BITS)).astype(np.int64)
    size = np.bincount(owner, minlength=len(texts))
    return keys & ((np.uint64(1) << (np.uint64(64) - _ROW_BITS)) - np.uint64(1)), np.concatenate([[0], np.cumsum(size)])


class IdFilter:
    """A bitmap of hashed ids, broadcast to the tasks: holds all the ids it is made of, and a few others.

    It has ``BITS_PER_ID`` bits for each id, at most ``MAX_BITS``; it comes through the driver by
    words of 64 bits.
    """

    def __init__(self, ids: DataFrame) -> None:
        n, self.bits = ids.count(), MIN_BITS
        while self.bits < min(BITS_PER_ID * n, MAX_BITS):
            self.bits *= 2
        found = ids.select(self.place()).groupBy(F.shiftright("place", 6).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("held")).toArrow()
        words = np.zeros(self.bits >> 6, np.int64)
        words[found.column("word").to_numpy()] = found.column("held").to_numpy()
        self.words = ids.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    def place(self):
        """The column, of a table with ``id``, by which :func:`_kept` finds the bit."""
        return F.pmod(F.xxhash64("id"), F.lit(self.bits)).alias("place")


def _kept(parts: Iterator[pa.RecordBatch], words) -> Iterator[pa.RecordBatch]:
    """The rows whose last column, the place, has its bit set in the broadcast ``words``."""
    for part in parts:
        place = part.columns[-1].to_numpy().view(np.uint64)
        held = (words.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
        yield part.filter(pa.array(held == 1))


def _slices(parts: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for start in range(0, part.num_rows, SLICE_ROWS):
            yield from ta.slices(part.slice(start, SLICE_ROWS), text)


# --- segments -----------------------------------------------------------------------------

class Bands:
    """Size bands, their numbers of segments, and how many segments a probe of a size needs."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(int(lows[-1] * BAND_RATIO), lows[-1]) + 1)
        self.low = np.array(lows)
        self.high = np.append(self.low[1:] - 1, 1 << 62)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, "right") - 1

    def differences(self, total: np.ndarray) -> np.ndarray:
        """The most elements in one of two similar sets only, by the sum of their sizes."""
        return (100 - self.percent) * total // (100 + self.percent)

    def segments(self, band: np.ndarray) -> np.ndarray:
        high = self.high[band]
        return self.differences(high + 100 * high // self.percent) + 1

    def below(self, size: np.ndarray) -> np.ndarray:
        """Whether a set of this size can be similar to one of the band below its own."""
        band = self.of(size)
        return (band > 0) & (self.low[band] > -(-self.percent * size // 100))


def segment_rows(
    tokens: np.ndarray, bounds: np.ndarray, which: np.ndarray, band: np.ndarray, own: bool,
    bands: Bands, dear: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, text, role) of the texts ``which`` in the bands ``band``."""
    size = (bounds[1:] - bounds[:-1])[which]
    m = bands.segments(band)
    base = np.cumsum(m) - m
    total = int(m.sum())
    text = np.repeat(np.arange(len(which)), m)  # of each segment
    seg = np.arange(total) - base[text]

    at = np.repeat(bounds[which] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    token, owner = tokens[at], np.repeat(np.arange(len(which)), size)
    slot = base[owner] + (ta.mixed(token) % m[owner].astype(np.uint64)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, value = slot[order], ta.mixed(token[order] + np.uint64(1))
    running = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
    filled = np.bincount(slot, minlength=total)
    stop = np.cumsum(filled)
    sums = running[stop] - running[stop - filled]
    salt = ta.mixed((band[text].astype(np.uint64) << np.uint64(40)) + seg.astype(np.uint64))
    signature = ta.mixed(sums ^ salt)

    # Cheap segments first; a probe takes as many as its size needs.
    needed = bands.differences(size + np.minimum(size, bands.high[band])) + 1
    costly = (filled == 0) * 2 + (np.isin(signature, dear) if len(dear) else 0)
    ranked = np.lexsort((-filled, costly, text))
    place = np.empty(total, np.int64)
    place[ranked] = np.arange(total) - base[text[ranked]]
    taken = place < needed[text]
    # A dear segment is left out for each cheap one that is taken with its neighbourhood too.
    near = (seg < np.maximum(m // NEIGHBOURHOODS, 1)[text]) & (m[text] > 1)
    could = near & taken & (costly == 0)
    spare = np.minimum(np.bincount(text[taken & (costly > 0)], minlength=len(which)),
                       np.bincount(text[could], minlength=len(which)))
    from_end = needed[text] - 1 - place
    dropped = taken & (costly > 0) & (from_end < spare[text])
    nth = np.cumsum(could) - could
    nth = nth - np.concatenate([[0], np.cumsum(np.bincount(text[could], minlength=len(which)))])[text]
    doubled = could & (nth < spare[text])
    taken &= ~dropped

    role = np.where(taken, PROBE, 0) + (INDEX if own else 0)
    wide = (near if own else doubled)[slot]  # tokens whose segment is given with its neighbourhood
    removed = slot[wide]
    deletions = ta.mixed((sums[removed] - value[wide]) ^ salt[removed])
    deleted_role = np.where(doubled[removed], PROBE, 0) + (INDEX if own else 0)
    use = role > 0
    return (np.concatenate([signature[use], deletions]),
            which[np.concatenate([text[use], text[removed]])],
            np.concatenate([role[use], deleted_role]))


def _signatures(
    docs: DataFrame, text: str, n: int, bands: Bands, dear: np.ndarray, firsts: IdFilter, index_only: bool = False,
) -> DataFrame:
    """(sig, id, size_role) rows of the documents in ``firsts``; ``size_role`` is 4 * size + role."""
    words = firsts.words

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _slices(_kept(parts, words), text):
            tokens, bounds = ngram_sets(piece.column(1), n)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            if not len(some):
                continue
            found = [segment_rows(tokens, bounds, some, bands.of(size[some]), True, bands, dear)]
            lower = some[bands.below(size[some])]
            if len(lower) and not index_only:
                found.append(segment_rows(tokens, bounds, lower, bands.of(size[lower]) - 1, False, bands, dear))
            sig, which, role = map(np.concatenate, zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig.view(np.int64)), piece.column(0).take(pa.array(which)), pa.array(4 * size[which] + role)],
                ["sig", "id", "size_role"])

    schema = docs.select(F.lit(0).cast("long").alias("sig"), "id", F.lit(0).cast("long").alias("size_role")).schema
    return docs.select("id", text, firsts.place()).mapInArrow(batches, schema)


def _dear_signatures(docs: DataFrame, text: str, n: int, bands: Bands, firsts: IdFilter) -> np.ndarray:
    """Segments that several documents of a bounded sample hold; they only steer costs.

    At most COST_SAMPLE documents on average, so the list is bounded too.
    """
    rate = min(1.0, COST_SAMPLE / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(rate * (1 << 20)))
    found = _signatures(sample, text, n, bands, np.zeros(0, np.uint64), firsts, index_only=True)
    rows = found.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= DEAR).select("sig").toArrow()
    return np.sort(rows.column("sig").to_numpy().view(np.uint64))


def _no_pair(size_role: np.ndarray, begins: np.ndarray, percent: int) -> np.ndarray:
    """Which buckets hold two rows that can be no pair by their roles and sizes, or no probe or index at all."""
    role, size = size_role & 3, size_role >> 2
    count = np.diff(np.append(begins, len(role)))
    out = (np.bitwise_or.reduceat(role, begins) != INDEX | PROBE) if len(begins) else np.zeros(0, bool)
    two = np.flatnonzero(count == 2)
    x, y = begins[two], begins[two] + 1
    def fits(a, b):
        return ((role[a] & PROBE) > 0) & ((role[b] & INDEX) > 0) & (size[a] >= size[b]) & (
            100 * size[b] >= percent * size[a])

    out[two] |= ~(fits(x, y) | fits(y, x))
    return out


def _meetings(signatures: DataFrame, partitions: int, percent: int) -> DataFrame:
    """(sig, id, size_role, centre) of the buckets where documents meet that may be a pair.

    The centre is the smallest id of its bucket. Rows stream through sorted by bucket; only the
    rows of one Arrow batch are held.
    """
    ordered = signatures.repartition(partitions, "sig").sortWithinPartitions("sig", "id")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last bucket of a batch may go on in the next: its first row waits, or its centre.
        last, waiting, centre = None, None, None
        for part in parts:
            if not part.num_rows:
                continue
            table = part if waiting is None else pa.Table.from_batches([waiting, part]).combine_chunks().to_batches()[0]
            sig, ids = (table.column(k).to_numpy() for k in (0, 1))
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            begins = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            centres = ids[begins].copy()
            known = last is not None and sig[0] == last and centre is not None
            if known:
                centres[0] = centre
            several = np.bincount(group, ids != centres[group]) > 0
            if known:
                several[0] = True
            # A bucket at the end in which one document only was seen may still grow.
            open_end = not several[-1]
            # Buckets that go on beyond this batch are not seen whole.
            useless = _no_pair(table.column(2).to_numpy(), begins, percent)
            useless[0] &= not known
            useless[-1] = False
            keep = (several & ~useless)[group]
            waiting = None
            if open_end:  # rows of one document, one of each size and role
                _, apart = np.unique(table.column(2).to_numpy()[begins[-1]:], return_index=True)
                waiting = table.take(pa.array(begins[-1] + apart))
            last, centre = sig[-1], None if open_end else centres[-1]
            if keep.any():
                rows = table.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(centres[group][keep], rows.schema.field(1).type)],
                    ["sig", "id", "size_role", "centre"])

    schema = signatures.withColumn("centre", F.col("id")).schema
    return ordered.mapInArrow(batches, schema)


# --- verification -------------------------------------------------------------------------

def sketches(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of bits per set: whether an odd number of elements falls to each place.

    Sets differ in at least as many elements as their sketches in bits.
    """
    n, places = len(bounds) - 1, 64 * SKETCH_WORDS
    owner = np.repeat(np.arange(n), np.diff(bounds))
    place = (ta.mixed(tokens + np.uint64(2)) % np.uint64(places)).astype(np.int64)
    odd = (np.bincount(owner * places + place, minlength=n * places) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, places), axis=1).view(np.int64)


_SKETCH = [f"sketch{k}" for k in range(SKETCH_WORDS)]
_SET = ["set0", "set1"]


def set_sizes(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """(id, size, sketch, hash) of the n-gram set of every row of ``docs`` (id, text)."""
    names = ["id", "size", *_SKETCH, *_SET]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _slices(parts, text):
            tokens, bounds = ngram_sets(piece.column(1), n)
            drawn = [pa.array(c) for c in np.ascontiguousarray(sketches(tokens, bounds).T)]
            sums = b"".join(hashlib.blake2b(tokens[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:]))
            equal = [pa.array(c) for c in np.ascontiguousarray(np.frombuffer(sums, np.int64).reshape(-1, 2).T)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(bounds)), *drawn, *equal], names)

    numbers = [F.lit(0).cast("long").alias(c) for c in names[1:]]
    return docs.select("id", text).mapInArrow(batches, docs.select("id", *numbers).schema)


def _firsts(sets: DataFrame) -> DataFrame:
    """(id, low) of every document that has n-grams; ``low`` is the smallest id of its set, null if it is alone."""
    some = sets.where("id is not null and size > 0").select("id", *_SET)
    shared = some.groupBy(*_SET).agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return saved(some.join(saved(shared, "shared"), _SET, "left").select("id", "low"), "firsts")


def _packed(docs: DataFrame, text: str, wanted: IdFilter) -> DataFrame:
    """(id, packed): compressed texts of the documents in ``wanted``, for a shuffle."""
    words = wanted.words

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor().compress
        for piece in (x for part in _kept(parts, words) for x in ta.slices(part, text)):
            texts = pa.array([press((t or "").encode()) for t in piece.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column(0), texts], ["id", "packed"])

    return docs.select("id", text, wanted.place()).mapInArrow(
        batches, docs.select("id", F.lit(b"").alias("packed")).schema)


def _may_be_similar(percent: int):
    """A condition on columns of two sets, _a and _b, that holds for all similar ones."""
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in _SKETCH), F.lit(0))
    return (100 * small >= percent * large) & ((100 + percent) * apart <= (100 - percent) * (small + large))


def _beside(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the columns of both ids, named _a and _b."""
    for s in "ab":
        pairs = pairs.join(table.select(*[F.col(c).alias(s if c == "id" else f"{c}_{s}") for c in table.columns]), s)
    return pairs


def _verified(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, n: int, percent: int, text: str) -> DataFrame:
    """The ``pairs`` (a, b) that are similar enough.

    Sketches rule out most of the others; texts travel only for what is left.
    """
    likely = saved(_beside(pairs, sizes).where(_may_be_similar(percent)).select("a", "b"), "likely")
    wanted = saved(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    texts = saved(_packed(docs, text, IdFilter(wanted)).join(wanted, "id"), "texts")
    forget(wanted)
    both = _beside(likely, texts)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = zstandard.ZstdDecompressor().decompress
        for part in parts:
            for start in range(0, part.num_rows, PAIRS_AT_ONCE):
                rows = part.slice(start, PAIRS_AT_ONCE)
                packed = [x for c in ("packed_a", "packed_b") for x in rows.column(c).to_pylist()]
                apart = list(dict.fromkeys(packed))
                opened = pa.record_batch([pa.array([free(x) for x in apart], pa.binary())], ["text"])
                grams = []
                for piece in ta.slices(opened, "text"):
                    tokens, bounds = ngram_sets(piece.column(0), n)
                    grams += [tokens[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                sets = dict(zip(apart, grams))
                good = []
                for x, y in zip(packed[:rows.num_rows], packed[rows.num_rows:]):
                    x, y = sets[x], sets[y]
                    if len(x) < len(y):
                        x, y = y, x
                    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    good.append(100 * common >= percent * (len(x) + len(y) - common))
                yield rows.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(batches, both.select("a", "b").schema)


def linked_documents(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
) -> tuple[DataFrame, DataFrame]:
    """(node, component) of every document that is linked with another one, and all set sizes."""
    bands = Bands(percent)
    docs = docs.select(F.col(doc_id).alias("id"), text)
    sizes = saved(set_sizes(docs, n, text), "sizes")
    classes = _firsts(sizes)
    copies = classes.where("id > low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    kept = classes.where("low is null or id = low").select("id")
    sketched = saved(sizes.drop(*_SET).join(kept, "id", "left_semi"), "sketches")
    docs = docs.where(F.col("id").isNotNull())
    partitions = slots(docs.sparkSession)
    firsts = IdFilter(kept)
    dear = _dear_signatures(docs, text, n, bands, firsts)
    met = saved(_meetings(_signatures(docs, text, n, bands, dear, firsts), partitions, percent), "meetings")

    # Dealt by one id, pairs become distinct and meet its sketch in one shuffle.
    first = saved(met.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
                  .repartition(partitions, "a").distinct(), "pairs")
    links = saved(_verified(first, sketched, docs, n, percent, text), "similar").unionByName(copies)
    nodes = components(links, "a", "b")

    # Where a bucket still holds several components, its pairs across them.
    place = met.join(nodes.withColumnRenamed("node", "id"), "id", "left").select(
        "sig", "id", F.col("size_role").bitwiseAND(3).alias("role"), F.coalesce("component", "id").alias("component"))
    mixed = saved(place.groupBy("sig").agg(F.min("component").alias("c"), F.max("component").alias("d"))
                  .where("c <> d").select("sig"), "mixed")
    open_rows = saved(place.join(mixed, "sig", "left_semi").join(sketched, "id"), "open")
    forget(met, mixed)
    a, b = (open_rows.select("sig", *[F.col(c).alias(f"{c}_{s}") for c in open_rows.columns if c != "sig"])
            for s in "ab")
    across = a.join(b, "sig").where(
        (F.col("component_a") != F.col("component_b"))
        & (F.col("role_a").bitwiseAND(PROBE) != 0) & (F.col("role_b").bitwiseAND(INDEX) != 0)
        & (F.col("size_a") >= F.col("size_b")) & _may_be_similar(percent))
    second = across.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    second = second.join(first, ["a", "b"], "left_anti").join(
        first.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    second = saved(second, "pairs")
    forget(open_rows, first)
    if second.isEmpty():
        return nodes, sizes
    more = saved(_verified(second, sketched, docs, n, percent, text), "similar")
    return (nodes if more.isEmpty() else components(links.unionByName(more), "a", "b")), sizes


def similar_documents(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` of each row of ``docs``."""
    found, sizes = linked_documents(docs, n, percent, text, doc_id)
    return sizes.join(found, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(doc_id), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def one_of_each_group(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with the smallest id of each component of similar documents."""
    found, _ = linked_documents(docs, n, percent, text, doc_id)
    dropped = saved(found.where("node <> component").select(F.col("node").alias(doc_id)), "near-copies")
    return docs.join(dropped, doc_id, "left_anti").select(docs.columns)
