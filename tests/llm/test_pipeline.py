"""The registered queries against SQL, and the pipeline against its stages one by one."""

import hashlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from qalathe.llm import queries

from test_dedup import suffix_want

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    def plain(v):
        if pd.isna(v):
            return None
        return int(v) if isinstance(v, float) and v == int(v) else v

    frame = frame[sorted(frame.columns)]
    return sorted([tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)], key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF_DIR).toPandas(), con.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SF_DIR).cache()
        assert seen.columns == docs.columns, name
        left = {r.doc_id: r for r in seen.collect()}
        assert left.keys() <= before.keys() and left, name
        if name != "suffix_dedup":
            assert all(r.text == before[d] for d, r in left.items())
    assert len({r.text for r in left.values()} - {""}) == len([r for r in left.values() if r.text])
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in out} == set(left)
    assert sum(r.length for r in out) == sum(len(r.ids) for r in out)


def test_suffix_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = suffix_want(rows, 50)
    got = queries.op5_suffix_dedup(spark, SF_DIR).collect()
    assert len(got) == len(rows) and sum(r.n_removed > 0 for r in got) > 0
    texts = dict(rows)
    for r in got:
        kept, *counts = want[(r.doc_id, (texts[r.doc_id] or "").encode())]
        assert [r.n_bytes, r.n_removed, r.n_spans] == counts and r.kept_sha256 == hashlib.sha256(kept).hexdigest()
