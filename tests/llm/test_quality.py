"""The classifier on held-out labels, and defined cases."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from qalathe.llm import quality


def test_held_out_labels_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [r for r in rows if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in test]) > 0.9
    assert np.mean([r.predicted for r in test if r.quality == 1]) > 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 1), (7, 0), (999, 1), (None, 1)], "doc_id long, quality int")
    rows = quality.quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    unlabelled = quality.quality_scores(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()
    assert quality.quality_scores(no_docs, labels).isEmpty() and quality.keep_good(no_docs, labels).isEmpty()


def test_features_do_not_depend_on_neighbours():
    texts = ["", "One line.\nOne line.\n", "a a a b", None, "É!! É!!", "x" * 50, "\n", "end"]
    together = quality.text_features(pa.array(texts))
    for k, text in enumerate(texts):
        assert np.allclose(together[k], quality.text_features(pa.array([text], pa.string()))[0], atol=1e-6), text
