"""Filter interaction audit against a plain-Python count over the same rows."""

import re
from itertools import permutations

from qalathe.llm import filter_audit
from qalathe.llm.filter_audit import SortedTrie


def _mask(doc_id, text, ids_by_text):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    m = 1 if len(words) < 100 else 0
    m |= 2 if 100 * len(set(words)) < 80 * len(words) else 0
    m |= 4 if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else 0
    m |= 8 if re.search(r"[#$%&*|]", t) else 0
    smaller = [k for k in ids_by_text[t] if k is not None]
    m |= 16 if doc_id is not None and smaller and doc_id > min(smaller) else 0
    return m


def brute(rows, labels):
    ids_by_text = {}
    for doc_id, text, _ in rows:
        ids_by_text.setdefault(text or "", []).append(doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs = [(lang or "", _mask(d, t, ids_by_text), d in good, d in toxic) for d, t, lang in rows]
    out = {}
    for part in {p for p, *_ in docs}:
        mine = [r for r in docs if r[0] == part]
        removed_by = {c: 0 for c in "ABCDE"}
        rows_p = []
        for order in ("".join(p) for p in permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                earlier = sum(1 << "ABCDE".index(c) for c in order[:step - 1])
                rem = [r for r in mine if r[1] & bit and not r[1] & earlier]
                removed_by[letter] += len(rem)
                rows_p.append([part, order, step, letter,
                               sum(1 for r in mine if not r[1] & (bit | earlier)), len(rem),
                               sum(1 for r in mine if r[1] & bit and r[1] & earlier),
                               sum(1 for r in mine if r[1] == bit),
                               sum(1 for r in rem if r[2]), sum(1 for r in rem if r[3])])
        for r in rows_p:
            out[(r[0], r[1], r[2])] = (*r[4:], removed_by[r[3]])
    return out


def _got(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in df.collect()}


def test_trie_flags_larger_ids_of_equal_keys():
    trie = SortedTrie()
    flags = [trie.insert(k, i) for k, i in [(b"a", 3), (b"ab", 1), (b"ab", 1), (b"ab", 2), (b"abc", 9), (b"b", None)]]
    assert flags == [False, False, False, True, False, False]
    assert trie.terminals == 4


def test_audit_equals_brute_force_on_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumn("lang", odd_docs.source)  # a column of the part with clashing names around
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    labels = [(1, 1, 0), (1, 0, 1), (4, 1, 1), (5, 0, 0), (None, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = _got(filter_audit.filter_audit(docs, lab))
    assert len(got) == 600
    assert got == brute(rows, labels)


def test_hot_copies_over_many_tasks(spark):
    words = " ".join(f"w{k}" for k in range(120))
    rows = [(k, words if k % 3 else f"{words} #{k % 7}", None if k % 5 == 0 else "en") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    lab = spark.createDataFrame([(k, k % 2, k % 3) for k in range(0, 600, 4)], "doc_id long, quality int, toxic int")
    got = _got(filter_audit.filter_audit(docs, lab))
    assert got == brute(rows, [(k, k % 2, k % 3) for k in range(0, 600, 4)])


def test_empty_table(spark, no_docs):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(no_docs, lab).count() == 0
