"""The n-gram join against all pairs."""

import random
import re

import pytest

from qalathe.llm import components, ngram_join


def sets_of(rows, n):
    out = []
    for doc_id, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append((doc_id, {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()))
    return out


def want(rows, n, percent):
    sets = sets_of(rows, n)
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return sorted([(d, len(s), None if d is None else find(d)) for d, s in sets], key=repr)


def got(docs, n, percent):
    return sorted([tuple(r) for r in ngram_join.similar_documents(docs, n, percent).collect()], key=repr)


@pytest.mark.parametrize("n, percent, words", [(4, 85, 40), (5, 80, 12), (1, 60, 6), (2, 100, 30)])
def test_against_all_pairs(spark, n, percent, words):
    rng = random.Random(percent)
    vocabulary = [f"w{k}" for k in range(words)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(25)]
    rows = []
    for k in range(150):
        base = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            base = base[:rng.randint(0, len(base))]
        rows.append((k, rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(docs, n, percent) == want(rows, n, percent)


def test_hot_groups(spark, monkeypatch):
    """Copies, near copies and a passage that a third of the documents share."""
    monkeypatch.setattr(ngram_join, "DEAR", 2)
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(k, passage + " " + " ".join(f"x{rng.randrange(300)}" for _ in range(30))) for k in range(60)]
    rows += [(100 + k, passage) for k in range(40)]
    rows += [(200 + k, passage + f" near{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs, 4, 85) == want(rows, 4, 85)


def test_equal_sets_meet_once(spark, monkeypatch):
    """Two large groups of copies that share many words: pairs are of sets, not of documents."""
    seen, verified = [], ngram_join._verified

    def noted(pairs, *others):
        seen.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(ngram_join, "_verified", noted)
    shared = " ".join(f"p{k}" for k in range(100))
    kinds = [shared + "".join(f" {x}{k}" for k in range(8)) for x in "abc"]
    rows = [(k, kinds[k % 3].upper() if k % 2 else kinds[k % 3]) for k in range(120)] + [(1, kinds[0]), (200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (85, 87):
        assert got(docs, 4, percent) == want(rows, 4, percent)
    assert sum(seen) <= 8


def test_id_filter(spark):
    ids = spark.range(0, 3000, 3)
    kept = ngram_join.IdFilter(ids)
    words = kept.words
    held = spark.range(3000).select("id", kept.place()).mapInArrow(
        lambda parts: ngram_join._kept(parts, words), "id long, place long")
    found = {r.id for r in held.collect()}
    assert found >= set(range(0, 3000, 3)) and len(found) < 1300
    assert not ngram_join.IdFilter(ids.limit(0)).words.value.any()


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(odd_docs, 4, 85) == want(rows, 4, 85)
    kept = ngram_join.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} >= {None, 0, 1, 2, 3, 4, 5, 7}
    assert ngram_join.similar_documents(no_docs).isEmpty() and ngram_join.one_of_each_group(no_docs).isEmpty()


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 200), (300, 200), (7, 7)]
    links = spark.createDataFrame(path, "a long, b long")
    found = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 200: 100, 300: 100}
    assert components.components(links.limit(0), "a", "b").isEmpty()
