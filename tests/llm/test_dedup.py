"""Exact, line and suffix deduplication against brute force."""

import hashlib
import random
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from qalathe.llm import exact_dedup, line_dedup, suffix_dedup

BLANKS = " \t\n\x0b\f\r"


def squeezed(text):
    out, run = [], False
    for c in text or "":
        if c in BLANKS:
            if not run:
                out.append(" ")
            run = True
        else:
            out.append(c)
            run = False
    return "".join(out)


def exact_want(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[squeezed(text)].append(doc_id)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        free = True
        for i in ids:
            kept = i == keep and free
            free = free and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def collide(block):
    """A hash under which many blocks meet, as any hash may."""
    return [F.pmod(F.length(block), F.lit(3))]


@pytest.mark.parametrize("block_chars, block_hash", [(4096, exact_dedup._block_hash), (3, collide)])
def test_exact_groups_of_odd_rows(odd_docs, block_chars, block_hash):
    docs = odd_docs.where("length(coalesce(text, '')) < 100") if block_chars < 10 else odd_docs
    got = [tuple(r) for r in exact_dedup.exact_groups(docs, block_chars=block_chars, block_hash=block_hash).collect()]
    assert sorted(got, key=repr) == exact_want([(r.doc_id, r.text) for r in docs.collect()])


def test_exact_names_of_many_blocks(spark):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in exact_dedup.exact_groups(docs, block_chars=2, block_hash=collide).collect()]
    assert sorted(got, key=repr) == exact_want(rows)


def test_exact_dedup_keeps_rows_whole(odd_docs, no_docs):
    kept = exact_dedup.exact_dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == len({squeezed(r.text) for r in odd_docs.collect()})
    assert sum(r.doc_id == 5 for r in rows) == 1
    assert exact_dedup.exact_dedup(no_docs).isEmpty() and exact_dedup.exact_groups(no_docs).isEmpty()


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def lines_want(rows, least):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    seen = defaultdict(int)
    for _, lines in split:
        for k in {key(x) for x in lines}:
            seen[k] += 1
    out = []
    for d, lines in split:
        left = [x for x in lines if not (len(key(x)) >= 1 and seen[key(x)] >= least)]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 2, 10])
def test_lines(spark, odd_docs, least):
    rng = random.Random(2)
    parts = ["Common", " common\t", "rare", "", "  ", "É", "é", "x\r", "two words"]
    rows = [(k % 40, "\n".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))) for k in range(60)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), odd_docs):
        out = line_dedup.drop_common_lines(docs, min_docs=least)
        assert set(out.columns) == {*docs.columns, "n_lines", "n_dropped"}
        got = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()], key=repr)
        assert got == lines_want([(r.doc_id, r.text) for r in docs.collect()], least)


def test_no_lines(no_docs):
    assert line_dedup.drop_common_lines(no_docs).isEmpty()


def suffix_want(rows, length):
    low, out = {}, {}
    for d, t in sorted((d, (t or "").encode()) for d, t in rows if d is not None):
        for p in range(len(t) - length + 1):
            low[t[p:p + length]] = min(d, low.get(t[p:p + length], d))
    for d, t in rows:
        t = (t or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1 if d is not None else 0):
            if low[t[p:p + length]] < d:
                gone[p:p + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.setdefault((d, t), (kept, len(t), int(gone.sum()), len(edges) // 2))
    return out


@pytest.mark.parametrize("length, gram, alphabet", [(10, 4, "ab é"), (6, 6, "abc"), (50, 16, "ab")])
def test_suffixes(spark, monkeypatch, length, gram, alphabet):
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_MERGE", 700)
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_BUCKET", 1500)
    rng = random.Random(length)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 90))) for _ in range(6)]
    rows = [(k, "".join(rng.choice(passages) if rng.random() < 0.5 else rng.choice(alphabet) for _ in range(rng.randint(0, 40))))
            for k in range(80)]
    rows += [(100 + k, rows[k][1]) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = suffix_want(rows, length)
    out = suffix_dedup.drop_repeated(docs, length, gram).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) == want[(r.doc_id, r.text.encode())]


@pytest.mark.parametrize("length, gram, alphabet", [(10, 4, "ab é"), (6, 6, "abc"), (50, 16, "ab")])
@pytest.mark.parametrize("most", [0, 12])
def test_suffixes_of_hot_grams(spark, monkeypatch, length, gram, alphabet, most):
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_PER_GRAM", most)
    monkeypatch.setattr(suffix_dedup, "PACKED_SLICE_BYTES", 500)
    test_suffixes(spark, monkeypatch, length, gram, alphabet)


def test_gram_buckets_are_small_and_few_share_a_task(spark, monkeypatch):
    """A bucket's grams are held by one task; none gets many of them, whatever their number."""
    seen, repeated = [], suffix_dedup._repeated_grams

    def noted(rows, buckets, slices):
        seen.append(buckets)
        return repeated(rows, buckets, slices)

    monkeypatch.setattr(suffix_dedup, "_repeated_grams", noted)
    monkeypatch.setattr(suffix_dedup, "MAX_BUCKETS", 7)
    monkeypatch.setattr(suffix_dedup, "BYTES_PER_BUCKET", 100)
    passage = "a passage that two of the documents hold, and no other one does. "
    rows = [(k, f"{k} only here " * 5 + (passage if k in (3, 8) else "")) for k in range(20)]
    found = {r.doc_id: r.n_removed for r in suffix_dedup.drop_repeated(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert seen == [7] and found[8] >= len(passage) and found[3] == 0


def test_one_gram_in_thousands_of_contexts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_PER_GRAM", 100, raising=False)
    monkeypatch.setattr(suffix_dedup, "PACKED_SLICE_BYTES", 20_000)
    whole = suffix_dedup._windows_held

    def bounded(rows, *rest):
        assert len(rows) <= 100
        return whole(rows, *rest)

    monkeypatch.setattr(suffix_dedup, "_windows_held", bounded)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    grams = [word(16) for _ in range(5000)]
    data = np.frombuffer("".join(grams).encode(), np.uint8)
    at = np.arange(0, len(data), 16)
    gram = grams[int(np.argmin(suffix_dedup.ta.span_hashes(data, at, at + 16)))]
    contexts = [word(40) + gram + word(40) for _ in range(3000)]
    rows = [(k, "".join(contexts[10 * k:10 * k + 10])) for k in range(300)]
    # Later ones hold parts of the contexts, short of a window and longer.
    rows += [(300 + k, word(30) + contexts[rng.randrange(3000)][rng.randrange(30):rng.randrange(60, 96)] + word(30)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = suffix_want(rows, 50)
    out = suffix_dedup.drop_repeated(docs).collect()
    assert len(out) == 600 and sum(r.n_removed > 0 for r in out) > 100
    for r in out:
        assert (bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) == want[(r.doc_id, r.text.encode())]


def test_suffixes_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = suffix_want([(d, t if len(t or "") < 1000 else t[:3000]) for d, t in rows], 50)
    out = suffix_dedup.drop_repeated(odd_docs).collect()
    assert len(out) == len(rows)
    for r in out:
        if len(r.text or "") < 1000:
            assert (bytes(r.kept), r.n_removed) == (want[(r.doc_id, (r.text or "").encode())][0], want[(r.doc_id, (r.text or "").encode())][2])
        else:
            assert r.n_removed == (0 if r.doc_id == 4 else len(r.text.encode()) - len(bytes(r.kept)))
    left = suffix_dedup.without_repeated(odd_docs)
    assert left.columns == odd_docs.columns and all(r.n_chars == len(r.text) for r in left.collect())
    assert suffix_dedup.drop_repeated(no_docs).isEmpty()


def test_suffixes_of_odd_rows_whole(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = suffix_want(rows, 50)
    for r in suffix_dedup.drop_repeated(odd_docs).collect():
        assert (bytes(r.kept), r.n_bytes, r.n_removed, len(r.spans)) == want[(r.doc_id, (r.text or "").encode())]


def test_loser_tree_knows_common_prefixes():
    rng = random.Random(5)
    for _ in range(200):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(4)) for _ in range(rng.randint(0, 6))}) for _ in range(rng.randint(1, 7))]
        coded = []
        for run in runs:
            rows = np.array([list(x) for x in run], np.uint8).reshape(-1, 4)
            coded.append((run, suffix_dedup._common(rows).tolist()))
        out = [(runs[r][k], common) for r, k, common in suffix_dedup.merged(coded)]
        assert [x for x, _ in out] == sorted(x for run in runs for x in run)
        for (x, _), (y, common) in zip(out, out[1:]):
            assert common == next((k for k in range(4) if x[k] != y[k]), 4)


# What a worker holds more, in MB, once it has cut 60 texts of 1 MB that lose every second 50 bytes.
HELD_BY_A_WORKER = """
import re
import numpy as np, pyarrow as pa
from qalathe.llm import suffix_dedup

def held():
    return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024

start = pa.array([list(range(0, 1_000_000, 100))] * 3)
size = pa.array([[50] * len(start[0])] * 3)
def parts():
    for _ in range(20):
        texts = pa.array(["x" * 1_000_000] * 3)
        yield pa.record_batch([texts, start, size, pa.array([False] * 3)], ["text", "__start", "__size", "__whole"])

before = held()
for _, rows in suffix_dedup._cut_rows(parts(), "text"):
    assert rows[0][2] == 500_000
del _, rows
print(held() - before)
"""


def test_a_worker_returns_the_memory_of_cut_texts():
    done = subprocess.run([sys.executable, "-c", HELD_BY_A_WORKER], capture_output=True, text=True, timeout=120, check=True)
    assert float(done.stdout) < 14
