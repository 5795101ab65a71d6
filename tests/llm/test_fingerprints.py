"""Fingerprints and their edits against a plain-Python walk over the rows in order."""

import hashlib

from qalathe.llm import fingerprints as fp
from tests.llm.conftest import LONG


def brute(rows):
    def key(r):
        return (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).hexdigest())
    ordered = sorted(rows, key=key)
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        nid, nxt = ordered[(i + 1) % len(ordered)]
        out.append(fp.judged(doc_id, text, fp.fingerprint(text), nxt, fp.fingerprint(nxt)))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in fp.fingerprints(df).collect()), key=repr)


def test_equals_brute_force_on_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert _got(odd_docs) == brute(rows)


def test_many_ranges_and_single_row(spark):
    rows = [(k // 3, f"text {k % 5} " * (k % 40)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert _got(df) == brute(rows)
    one = spark.createDataFrame([(1, "only one text here")], "doc_id long, text string")
    assert _got(one) == brute([(1, "only one text here")])


def test_fingerprint_properties(monkeypatch):
    a = fp.fingerprint(LONG)
    assert len(a) == 70 and a == fp.fingerprint(LONG) and fp.likeness(a, a) == 1.0
    monkeypatch.setattr(fp, "SLICE", 1000)  # slices give the same counts as one pass
    assert fp.fingerprint(LONG) == a
    assert fp.fingerprint(None) == fp.fingerprint("") and fp.likeness(a, fp.fingerprint("")) < 0.5
    text = " ".join(f"word{k * 7919 % 10007}" for k in range(3000))
    other = " ".join(f"term{k * 104729 % 7001}x" for k in range(3000))
    near = fp.likeness(fp.fingerprint(text), fp.fingerprint(text[:-200] + "other words at the end"))
    assert near > fp.likeness(fp.fingerprint(text), fp.fingerprint(other))
    assert fp.edited("abcdefg", "XYZ") == "abcdeXY" and fp.edited(None, "x") == ""


def test_empty_table(spark, no_docs):
    assert fp.fingerprints(no_docs).count() == 0
