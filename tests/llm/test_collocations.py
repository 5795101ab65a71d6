"""Phrase collocations against a plain-Python count, with small thresholds so that phrases qualify."""

import re
from collections import Counter

import pytest

from qalathe.llm import collocations


def brute(rows, min_count, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        part = lang if lang is not None else "und"
        t = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[part] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    counts[(part, " ".join(ws[i:i + m]))] += 1
    cands = {k: v for k, v in counts.items() if v >= min_count and " " in k[1]}
    best = {}
    for (part, phrase), a in cands.items():
        ws, n = phrase.split(" "), totals[part]
        scored = []
        for k in range(1, len(ws)):
            l, r = counts[(part, " ".join(ws[:k]))], counts[(part, " ".join(ws[k:]))]
            scored.append((1000 * a * n // (l * r), k, l, r))
        best[(part, phrase)] = (a, n, *min(scored))
    out = []
    for (part, phrase), (a, n, score, k, l, r) in best.items():
        inside = any(f >= a and len(p2.split(" ")) > len(phrase.split(" ")) and f" {phrase} " in f" {p2} "
                     for (q, p2), f in cands.items() if q == part)
        if not inside:
            out.append((part, phrase, a, l, r, n, score))
    rows_out = []
    for part in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == part), key=lambda o: (-o[6], -o[2], o[1].encode()))
        rows_out += [(part, rank, *o[1:]) for rank, o in enumerate(mine[:top], 1)]
    return sorted(rows_out)


def _rows(spark, rows, min_count, top):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = collocations.collocations(df, min_count=min_count, top=top)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


TEXTS = [
    ("New York is big. new york, New York City! the City of new york", "en"),
    ("in new york city the big apple; The Big Apple in New York City", "en"),
    ("der Hund der Hund\tder Hund. die Katze", None),
    ("der Hund der Hund der Hund die Katze die Katze", None),
    (None, "en"), ("", "fr"), ("...;;;", "fr"), ("  \t ", "de"),
    ("new york city " * 50, "en"),
]


def test_equals_brute_force(spark):
    assert _rows(spark, TEXTS, 3, 5) == brute(TEXTS, 3, 5)
    assert _rows(spark, TEXTS * 2, 4, 100) == brute(TEXTS * 2, 4, 100)


def test_hat_trie_bursts_and_spills(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(collocations, "BURST", 2)
    monkeypatch.setattr(collocations, "SPILL", 3)
    counter = collocations.HatCounter(3)
    for phrases in (["a b c", "a b d"], ["a c d", "a b c"], ["b a a"]):
        table = pa.table({"part": ["en"] * len(phrases), "phrase": phrases, "f": [1] * len(phrases)})
        counter.add(table, np.array([hash(p.split()[0]) % 7 for p in phrases], dtype=np.uint64))
    got = sorted(r for run in counter.runs(True) for r in zip(*(run.column(c).to_pylist() for c in ("part", "phrase", "f"))))
    assert got == [("en", "a b c", 2), ("en", "a b d", 1), ("en", "a c d", 1), ("en", "b a a", 1)]
    assert list(counter.runs(True)) == []


def test_a_full_trie_is_merged_before_it_leaves(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(collocations, "SPILL", 10)
    counter, left = collocations.HatCounter(2), []
    for k in range(20):
        counter.add(pa.table({"part": ["en"] * 3, "phrase": ["a b", "b c", "c d"], "f": [1, 2, 3]}),
                    np.array([1, 2, 3], dtype=np.uint64))
        left += counter.runs(False)
    assert left == [] and counter.rows.sum() <= 10
    got = {run.column("phrase")[0].as_py(): run.column("f").to_pylist() for run in counter.runs(True)}
    assert got == {"a b": [20], "b c": [40], "c d": [60]}


def test_phrases_leave_once_a_counting_task(spark, monkeypatch):
    """The number of counting tasks follows the cores, not the partitions of the table."""
    sent, count = spark.sparkContext.accumulator(0), collocations.count_phrases

    def noted(bitmaps):
        run = count(bitmaps)

        def counted(batches):
            for batch in run(batches):
                sent.add(batch.num_rows - batch.column(1).null_count)
                yield batch
        return counted

    monkeypatch.setattr(collocations, "count_phrases", noted)
    tasks = collocations.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    rows = [("one two", "en")] * (16 * tasks)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4 * tasks)
    frequent, _ = collocations.phrase_counts(docs, min_count=5)
    assert {r.phrase: r.f for r in frequent.collect()} == dict.fromkeys(["one", "two", "one two"], len(rows))
    assert 0 < sent.value <= 3 * tasks


def test_long_text_and_empty_table(spark):
    long = [(" ".join(f"w{k % 7} w{k % 5}" for k in range(20000)), "en")]
    assert _rows(spark, long, 100, 2000) == brute(long, 100, 2000)
    assert _rows(spark, [], 1, 10) == []
