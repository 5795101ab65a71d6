"""Slices, verdicts and suggestions."""

import statistics

import pytest
from pyspark.sql import functions as F

from qalathe.plans import bias as B


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, "a" if i % 2 else "b", None if i == 0 else "simple", ["x", "x"] if i % 4 == 0 else ["y", "z"],
             ["E"] if i == 7 else [], None, float(i), i % 5, "q" * (i + 1), "a" * (2 * i + 1)) for i in range(60)]
    return spark.createDataFrame(rows, "question_id long, question_type string, complexity string, tags array<string>, "
                                       "error_signatures array<string>, infra_components array<string>, "
                                       "quality_score double, answer_score long, question_body string, answer_body string")


def test_slices(frame):
    assert {r.value: r["count"] for r in B.slices_of(frame, "question_type").collect()} == {"a": 30, "b": 30}
    assert B.slices_of(frame, "question_type", 31).count() == 0
    assert {r.value: r["count"] for r in B.slices_of(frame, "tags", 0).collect()} == {"x": 15, "y": 45, "z": 45}
    assert {r.value: r["count"] for r in B.slices_of(frame, "complexity", 1).collect()} == {"simple": 59}
    assert B.slices_of(frame, "infra_components", 1).count() == 0


def test_metrics(frame):
    got = {r.slice: r for r in B.slice_metrics(frame, 1).collect()}
    assert set(got) == {"a", "b", "simple", "tag_x", "tag_y", "tag_z", "error_E"}
    xs = [float(i) for i in range(0, 60, 4)]
    x = got["tag_x"]
    assert x["count"] == 15 and x.proportion == 0.25
    assert x.quality_score_mean == pytest.approx(statistics.mean(xs))
    assert x.quality_score_std == pytest.approx(statistics.stdev(xs))
    assert x.quality_score_median == statistics.median(xs)
    assert x.answer_length_mean == pytest.approx(statistics.mean(2 * i + 1 for i in range(0, 60, 4)))
    assert got["error_E"].quality_score_std is None
    overall = B.overall_metrics(frame).head()
    assert overall["count"] == 60 and overall.proportion == 1.0 and overall.quality_score_median == 29.5


def test_shares(frame):
    rows = {(r.dimension, r.value): r for r in B.slice_shares(frame, "complexity", 1).collect()}
    assert rows[("question_type", "b")].n == 29 and rows[("question_type", "b")].share == 1.0


def metric_rows(spark, rows):
    df = spark.createDataFrame(rows, "slice string, quality_score_mean double, answer_length_mean double, "
                                     "proportion double, count long")
    return df.withColumns({"dimension": F.lit("tags"), "value": F.col("slice")})


def judged(spark, overall, *rows, **options):
    whole = spark.createDataFrame([overall], "quality_score_mean double, answer_length_mean double")
    return {r.slice: r for r in B.bias_verdicts(metric_rows(spark, list(rows)), whole, **options).collect()}


def test_verdicts(spark):
    got = judged(
        spark, (10.0, 100.0), ("same", 10.0, 100.0, 0.5, 100), ("low", 5.0, 100.0, 0.5, 100),
        ("slight", 7.4, 100.0, 0.5, 100), ("edge", 7.5, 150.0, 0.5, 100), ("far", 18.0, 100.0, 0.5, 100),
        ("long", 10.0, 151.0, 0.5, 100), ("rare", 10.0, 100.0, 0.003, 10), ("few", 10.0, 100.0, 0.006, 10),
        ("all", 5.0, 20.0, 0.001, 5), ("both", 7.0, 40.0, 0.5, 100))
    assert {k: v.severity for k, v in got.items()} == {
        "same": "none", "low": "low", "slight": "low", "edge": "none", "far": "high", "long": "medium",
        "rare": "low", "few": "none", "all": "high", "both": "medium"}
    factor = got["low"].bias_factors[0]
    assert (factor.factor, factor.slice_value, factor.difference_ratio, factor.direction) == ("quality_score", 5.0, 0.5, "lower")
    assert got["rare"].bias_factors[0].slice_proportion == 0.003 and got["rare"].is_biased


def test_threshold_zero_is_kept(spark):
    got = judged(spark, (10.0, 100.0), ("near", 9.99, 100.0, 0.5, 100), threshold=0.0)
    assert got["near"].is_biased


def test_no_verdict_without_positive_mean(spark):
    got = judged(spark, (0.0, 0.0), ("x", -5.0, 100.0, 0.5, 100))
    assert got["x"].severity == "none"


def test_suggestions(spark):
    whole = spark.createDataFrame([(10.0, 100.0)], "quality_score_mean double, answer_length_mean double")
    rows = metric_rows(spark, [("low", 5.0, 100.0, 0.5, 100), ("high", 20.0, 100.0, 0.5, 100),
                               ("long", 10.0, 200.0, 0.5, 100), ("rare", 10.0, 100.0, 0.003, 10)])
    got = {r.slice: r for r in B.suggestions(B.bias_verdicts(rows, whole)).collect()}
    assert {k: (v.strategy, v.priority) for k, v in got.items()} == {
        "low": ("quality_filtering", "medium"), "long": ("length_normalization", "low"),
        "rare": ("data_augmentation", "high")}
    assert got["long"].issue == "Answers are longer than average"


def test_report(frame):
    report = B.bias_report(frame, min_samples=1)
    summary = report["summary"].head()
    assert summary.total_slices == 7
    run = B.bias_run_metrics(report["slices"]).head()
    assert run.mitigation_suggestions_count == report["suggestions"].count()
    assert summary.biased_slices == B.biased_slices(report["slices"]).count()


def test_empty_table_has_no_slices(frame):
    report = B.bias_report(frame.limit(0), min_samples=1)
    row = report["summary"].head()
    assert row.total_slices == 0 and row.bias_rate == 0.0
