"""Checks, outliers, statistics, verdict and gate, with empty, all-null and repeated input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qalathe import defaults as D
from qalathe.plans import profile, validate as V
from qalathe.plans.checks import verdict


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i + 1, f"Test question {i + 1}", f"Is this question {i + 1} on pods long enough to pass the check?",
             f"An answer {i + 1} with steps that are long enough to count, " * 3,
             ["kubernetes"] if i % 2 == 0 else ["terraform"], 10 + i % 20, 15 + i % 15, 25.0 + i % 10) for i in range(100)]
    return spark.createDataFrame(rows, "question_id long, title string, question_body string, answer_body string, "
                                       "tags array<string>, score long, answer_score long, quality_score double")


def by_check(checks):
    return {(r.check, r.column): r for r in checks.collect()}


def test_good_table(frame):
    checks = V.validation_checks(frame)
    got = by_check(checks)
    assert got[("schema_required_columns", None)].status == "pass"
    assert got[("min_rows", None)].message == "Row count (100) meets minimum (100)"
    assert got[("feature_distribution", "tags")].status == "warn"
    assert ("empty_strings", "title") not in got
    v = verdict(checks).head()
    assert v.is_valid and v.failed_count == 0 and v.total_checks == v.passed_count


def test_failures(spark):
    df = spark.createDataFrame([(1, "test", " \t"), (1, None, "x"), (None, "q", "y"), (None, "q", "z")],
                               "question_id long, question_body string, answer_body string")
    got = by_check(V.validation_checks(df))
    assert got[("schema_required_columns", None)].severity == "error"
    assert got[("min_rows", None)].message == "Only 4 rows, minimum required: 100"
    assert got[("missing_values", "question_id")].status == "fail"
    assert got[("missing_values", "question_id")].message == "Column 'question_id' has 50.0% missing values"
    assert got[("duplicates", "question_id")].message == "Found 2 duplicate question_ids (50.0%)"
    assert got[("empty_strings", "answer_body")].value == 1
    assert not verdict(V.validation_checks(df)).head().is_valid


def test_few_missing_values_only_warn(spark):
    df = spark.range(200).selectExpr("IF(id = 3, NULL, id) AS question_id", "'q' AS question_body")
    got = by_check(V.quality_checks(df))
    assert got[("missing_values", "question_id")].message == "Column 'question_id' has 1 missing values (0.5%)"
    assert got[("duplicates", "question_id")].status == "pass"


def test_empty_table(spark):
    df = spark.createDataFrame([], "question_id long, question_body string, answer_body string, score long, "
                                   "quality_score double, tags array<string>")
    got = by_check(V.validation_checks(df))
    assert got[("missing_values", "question_id")].status == "pass"
    assert got[("duplicates", "question_id")].status == "pass"
    assert got[("min_rows", None)].status == "fail"
    assert V.anomalies(df).count() == 0
    assert all(r["count"] == 0 and r.q50 is None for r in V.describe_numbers(df).collect())


def test_extra_columns_warn(frame):
    got = by_check(V.schema_checks(frame.withColumn("colour", frame.score)))
    assert got[("schema_extra_columns", None)].message == "Unexpected columns found: {'colour'}"


def test_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, -90.0, None]
    df = spark.createDataFrame(list(enumerate(values)), "question_id int, score double")
    got = {r.question_id: r for r in V.anomalies(df, ("score",)).collect()}
    q25, q75 = np.quantile([v for v in values if v is not None], [0.25, 0.75])
    assert set(got) == {4, 5}
    assert got[4].upper_bound == pytest.approx(q75 + 1.5 * (q75 - q25))
    counts = V.outlier_counts(df, ("score",)).head()
    assert counts.outliers_score == counts.total_anomalies == 2


def test_describe_numbers(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (10, None)], "a int, b double")
    got = {r.column: r for r in V.describe_numbers(df).collect()}
    assert (got["a"].q25, got["a"].q50, got["a"].q75) == (1.75, 2.5, 4.75)
    assert got["a"].std == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert got["b"]["count"] == 0 and got["b"].mean is None and got["b"].q50 is None


def test_std_of_one_row_is_null(spark):
    assert V.describe_numbers(spark.createDataFrame([(1,)], "a int")).head().std is None


def test_gate(spark, frame, tmp_path):
    bad = frame.limit(3)
    assert V.gated(frame, V.quality_checks(frame)).count() == 100
    assert V.gated(bad, V.quality_checks(bad)).count() == 0
    place = str(tmp_path / "validated")
    assert not V.promote(bad, V.quality_checks(bad), place)
    assert V.promote(frame, V.quality_checks(frame), place)
    assert not V.promote(bad, V.quality_checks(bad), place)
    assert V.read_validated(spark, place).count() == 100


def test_promotion_that_dies_while_writing_keeps_the_last_version(spark, frame, tmp_path, monkeypatch):
    place = str(tmp_path / "validated")
    assert V.read_validated(spark, place) is None
    assert V.promote(frame, V.quality_checks(frame), place)
    first = sorted(r.title for r in V.read_validated(spark, place).collect())

    def dies(df, path):
        df.limit(1).write.parquet(path)  # part of the version is there
        raise RuntimeError("executor lost")

    monkeypatch.setattr(V, "write_table", dies)
    changed = frame.withColumn("title", F.concat(frame.title, F.lit("!")))
    with pytest.raises(RuntimeError):
        V.promote(changed, V.quality_checks(changed), place)
    assert sorted(r.title for r in V.read_validated(spark, place).collect()) == first


def test_profile(spark):
    long_text = "z" * 200
    df = spark.createDataFrame(
        [(1, "a", None, ["x"]), (2, "a", None, ["x"]), (2, "a", None, ["x"]), (None, long_text, None, None)],
        "n int, t string, nothing double, l array<string>")
    got = {r.column: r for r in profile.column_profile(df).collect()}
    assert got["n"].null_percentage == 25.0 and got["n"].median == 2.0
    assert (got["t"].unique_count, got["t"].min_length, got["t"].max_length) == (2, 1, 200)
    assert got["nothing"]["count"] == 0 and got["nothing"].mean is None
    assert got["l"]["count"] == 3 and got["l"].unique_count is None
    assert {(r.value, r.n) for r in profile.common_texts(df).collect()} == {("a", 3), (long_text, 1)}
    info = profile.dataset_info(df).head()
    assert (info.row_count, info.column_count, info.duplicate_rows) == (4, 4, 1)


def test_many_values_have_no_common_list(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS t", "CAST(id % 99 AS STRING) AS u")
    rows = profile.common_texts(df).collect()
    assert {r.column for r in rows} == {"u"} and len(rows) == 5 and rows[0].n == 2


def test_expectations(spark, frame):
    rules = profile.table_expectations()
    results = profile.check_expectations(frame, rules).collect()
    assert len(results) == 10 and all(r.status == "pass" for r in results)
    bad = frame.selectExpr("question_id % 50 AS question_id", "score - 15 AS score", "quality_score", "answer_body")
    got = {(r.check, r.column): r.status for r in profile.check_expectations(bad, rules).collect()}
    assert got[("column_exists", "question_body")] == "fail" and got[("values_unique", "question_id")] == "fail"
    assert got[("values_between", "score")] == "fail" and got[("values_between", "quality_score")] == "pass"


def test_low_minimum_counts_but_stays_valid(frame):
    low = frame.withColumn("score", frame.score - 100)
    results = profile.check_expectations(low, profile.declared_expectations(), skip_absent=True)
    row = profile.expectation_metrics(low, results).head()
    assert row.schema_valid and row.checks_failed == 1 and row.row_count == 100
    assert len(profile.declared_expectations()) == 15
    assert {e.name for e in profile.declared_expectations(every_key=True)} >= {"title_length", "score_type"}
    assert D.MAX_ROWS == 1_000_000
