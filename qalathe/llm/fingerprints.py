"""Document fingerprints by quartile bucket digests, and their likeness after an edit.

A fingerprint counts the byte triplets of every 5-byte window of the UTF-8 text: six triplets a
window, each hashed by a Pearson table into 256 buckets, of which the first 128 are kept. The
quartiles of those counts code each bucket in two bits (64 hex digits). A header adds a one-byte
checksum of all bytes, a length code (logarithmic) and the ratios of the first two quartiles to the
third. Two fingerprints differ by a bounded score: header parts by their distance, buckets by the
distance of their codes (6 where they are three apart); likeness is 1 - min(score, LIMIT) / LIMIT.
Equal texts have equal fingerprints.

The edit of a text replaces its last floor(n/3) code points by the first as many of the next
document, in the order of descending id (the last one's next is the first). Rows are dealt by range
in that order; each range is fingerprinted in order in one pass, the last row of a range waits for
the first row of the next one. Only those, two rows a range, meet in a second step.

Defined cases. A null text is empty: n_chars 0, a fingerprint of zero counts, an edit that is
empty. Texts under 5 bytes have no windows and zero counts. Rows of equal id are ordered by the
SHA-256 of their text, then by their place in the input; rows equal in id and text are
interchangeable, so the result as a multiset does not depend on it. A single row is its own next.
Texts of any length are counted in slices of ``SLICE`` bytes. Other columns never matter. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .work import saved

BUCKETS = 128
LIMIT = 400
SLICE = 1 << 20
SEED = 1469598103
# Salts of the six triplets of a window (b0 b1 b2 b3 b4): which bytes, and the Pearson start.
TRIPLETS = ((0, 1, 2, 2), (0, 1, 3, 3), (0, 2, 3, 5), (0, 2, 4, 7), (0, 1, 4, 11), (0, 3, 4, 13))

_TABLE = np.random.default_rng(SEED).permutation(256).astype(np.uint8)
_OUT = ("kind string, pid int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, text string")


def _counts(data: bytes) -> np.ndarray:
    counts = np.zeros(256, dtype=np.int64)
    for lo in range(0, max(len(data) - 4, 0), SLICE):
        b = np.frombuffer(data, dtype=np.uint8, count=min(SLICE + 4, len(data) - lo), offset=lo)
        if len(b) < 5:
            break
        w = [b[i:len(b) - 4 + i] for i in range(5)]
        for x, y, z, salt in TRIPLETS:
            h = _TABLE[_TABLE[_TABLE[_TABLE[salt] ^ w[z]] ^ w[y]] ^ w[x]]
            counts += np.bincount(h, minlength=256)
    return counts[:BUCKETS]


def _checksum(data: bytes) -> int:
    if not data:
        return 0
    h = np.frombuffer(hashlib.blake2b(data, digest_size=1).digest(), dtype=np.uint8)[0]
    return int(_TABLE[h])


def fingerprint(text: str | None) -> str:
    """70 hex digits: checksum, length code, quartile ratios, then 128 two-bit bucket codes."""
    data = (text or "").encode()
    counts = _counts(data)
    q1, q2, q3 = (int(v) for v in np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]])
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = np.packbits(np.unpackbits(codes[:, None], axis=1)[:, -2:].reshape(-1)).tobytes().hex()
    length = min(int(math.log(len(data) + 1, 1.5)), 255)
    ratios = ((q1 * 100 // q3) % 16) << 4 | ((q2 * 100 // q3) % 16) if q3 else 0
    return f"{_checksum(data):02x}{length:02x}{ratios:02x}{body}"


def _circular(a: int, b: int, size: int) -> int:
    d = abs(a - b)
    return min(d, size - d)


def difference(a: str, b: str) -> int:
    """Difference score of two fingerprints, 0 for equal ones."""
    score = int(a[:2] != b[:2])
    dl = abs(int(a[2:4], 16) - int(b[2:4], 16))
    score += dl if dl <= 1 else dl * 12
    ra, rb = int(a[4:6], 16), int(b[4:6], 16)
    for d in (_circular(ra >> 4, rb >> 4, 16), _circular(ra & 15, rb & 15, 16)):
        score += d if d <= 1 else (d - 1) * 12
    ca = np.unpackbits(np.frombuffer(bytes.fromhex(a[6:]), dtype=np.uint8)).reshape(-1, 2)
    cb = np.unpackbits(np.frombuffer(bytes.fromhex(b[6:]), dtype=np.uint8)).reshape(-1, 2)
    diff = np.abs((ca[:, 0] * 2 + ca[:, 1]).astype(int) - (cb[:, 0] * 2 + cb[:, 1]))
    return score + int(np.where(diff == 3, 6, diff).sum())


def likeness(a: str, b: str) -> float:
    return 1.0 - min(difference(a, b), LIMIT) / LIMIT


def edited(text: str | None, following: str | None) -> str:
    """The text with its last floor(n/3) code points replaced by the first as many of the next."""
    t, nxt = text or "", following or ""
    k = len(t) // 3
    return t[:len(t) - k] + nxt[:k]


def judged(doc_id, text: str | None, own: str, following: str | None, following_fp: str) -> tuple:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    e = edited(text, following)
    efp = fingerprint(e)
    return (doc_id, len(text or ""), hashlib.sha256(e.encode()).hexdigest(), own, efp, likeness(own, efp),
            likeness(own, following_fp))


def _batch(rows: list[tuple], kinds: list[str], pid: int, texts: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
    names = ["kind", "pid", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next", "text"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
             pa.float64(), pa.float64(), pa.string()]
    arrays = [kinds, [pid] * len(kinds), *cols, texts]
    return pa.RecordBatch.from_arrays([pa.array(list(a), t) for a, t in zip(arrays, types)], names=names)


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range in order: every row judged against the next; the first and last rows also leave
    as ``first`` and ``last`` with their text, for the rows of other ranges that need them."""
    pending, pid, first = None, 0, True
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        pids = batch.column("pid").to_pylist()
        rows, kinds, carried = [], [], []
        for doc_id, text, pid in zip(ids, texts, pids):
            own = fingerprint(text)
            if first:
                rows.append((doc_id, len(text or ""), None, own, None, None, None))
                kinds.append("first")
                carried.append(text)
                first = False
            if pending is not None:
                rows.append(judged(pending[0], pending[1], pending[2], text, own))
                kinds.append("row")
                carried.append(None)
            pending = (doc_id, text, own)
        if rows:
            yield _batch(rows, kinds, pid, carried)
    if pending is not None:
        yield _batch([(pending[0], len(pending[1] or ""), None, pending[2], None, None, None)], ["last"], pid,
                     [pending[1]])


def _closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [judged(d, t, fp, nt, nfp) for d, t, fp, nt, nfp in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_fp")))]
        yield _batch(rows, ["row"] * len(rows), 0, [None] * len(rows))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("sha"),
                        F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").desc_nulls_last(), "sha", "place"]
    ranged = (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("doc_id", "text", F.spark_partition_id().alias("pid")))
    passed = saved(ranged.mapInArrow(in_order, _OUT), "fingerprints")
    ends = passed.where(F.col("kind") != "row").select(
        "kind", "pid", "doc_id", "fingerprint", "text", F.when(F.col("kind") == "first", 0).otherwise(1).alias("o"))
    # At most two rows a range, so one task holds them all.
    later = Window.orderBy("pid", "o").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("pid", "o").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = F.struct(F.col("text").alias("t"), F.col("fingerprint").alias("f"))
    is_first = F.col("kind") == "first"
    joined = ends.select(
        "*", F.coalesce(F.first(F.when(is_first, firsts), ignorenulls=True).over(later),
                        F.first(F.when(is_first, firsts), ignorenulls=True).over(everything)).alias("nx"))
    closing = joined.where(F.col("kind") == "last").select(
        "doc_id", "text", "fingerprint", F.col("nx.t").alias("next_text"), F.col("nx.f").alias("next_fp"))
    rows = passed.where(F.col("kind") == "row").unionByName(closing.mapInArrow(_closing, _OUT))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next")
