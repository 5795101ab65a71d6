"""Exact quantiles against numpy, on smooth, heavily repeated and skewed values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qalathe.operators import column_quantiles, exact_quantiles

PROBS = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}


def frames():
    rng = np.random.default_rng(7)
    return {
        "smooth": rng.normal(size=5000), "repeated": rng.integers(0, 4, 5000).astype(float),
        "one": np.array([3.5]), "two": np.array([1.0, 2.0]), "same": np.full(1000, 2.25),
        "hot": np.concatenate([np.zeros(3000), rng.exponential(size=1500) * 1e6]),
        "small": np.array([1.0, 2.0, 3.0, 10.0]), "negative": -rng.exponential(size=700),
    }


@pytest.mark.parametrize("few_groups", [True, False])
def test_equal_to_numpy(spark, few_groups):
    data = frames()
    rows = [(k, float(v)) for k, values in data.items() for v in values] + [("null", None), ("one", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, few_groups=few_groups).collect()}
    assert set(got) == set(data)
    for k, values in data.items():
        want = np.quantile(values, list(PROBS.values()))
        np.testing.assert_allclose([got[k][p] for p in PROBS], want, rtol=1e-12, atol=1e-12)


def test_approximate_is_close(spark):
    df = spark.range(10_001).selectExpr("1 AS k", "id AS v")
    got = exact_quantiles(df, ["k"], "v", {"m": 0.5}, approximate=True).head()
    assert abs(got.m - 5000) <= 2


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(df, ["k"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("few_groups", [True, False])
def test_rounds_narrow_large_buckets(spark, monkeypatch, few_groups):
    from qalathe.operators import quantiles

    monkeypatch.setattr(quantiles, "MAX_RANKED", 40)
    data = frames()
    rows = [(k, float(v)) for k, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, few_groups=few_groups).collect()}
    for k, values in data.items():
        want = np.quantile(values, list(PROBS.values()))
        np.testing.assert_allclose([got[k][p] for p in PROBS], want, rtol=1e-12, atol=1e-12)


def test_no_task_ranks_more_than_the_bound(spark, monkeypatch):
    from qalathe.operators import quantiles

    monkeypatch.setattr(quantiles, "MAX_RANKED", 500)
    df = spark.range(200_000).selectExpr("'c' AS k", "CAST(id * 7 % 200000 AS DOUBLE) AS v")
    seen = []
    original = quantiles._narrowed

    def spy(placed, targets, keys):
        placed, targets = original(placed, targets, keys)
        seen.append(targets.agg({"_bn": "max"}).first()[0])
        return placed, targets

    monkeypatch.setattr(quantiles, "_narrowed", spy)
    got = exact_quantiles(df, ["k"], "v", {"m": 0.5, "p9": 0.9}, few_groups=False).first()
    assert (got.m, got.p9) == (99999.5, 179999.1) or abs(got.p9 - 179999.1) < 1e-6
    assert seen and seen[-1] <= 500


def wide_frame(spark, data):
    longest = max(len(v) for v in data.values())
    rows = [tuple(float(v[i]) if i < len(v) else None for v in data.values()) for i in range(longest)]
    return spark.createDataFrame(rows, ", ".join(f"{k} double" for k in data)).repartition(4)


@pytest.mark.parametrize("bound", [2_000_000, 40, 0])
def test_columns_equal_to_numpy(spark, monkeypatch, bound):
    from qalathe.operators import quantiles

    monkeypatch.setattr(quantiles, "MAX_RANKED", bound)
    monkeypatch.setattr(quantiles, "ROWS_AT_ONCE", 700)
    data = frames()
    # Numbers that share their first 48 bits.
    data["close"] = 1.0 + np.random.default_rng(8).integers(0, 2000, 3000) * 2.0 ** -52
    df = wide_frame(spark, {**data, "null": []}).withColumn("whole", F.col("two").cast("int"))
    got = {r["column"]: r for r in column_quantiles(df, df.columns, PROBS).collect()}
    assert set(got) == {*data, "whole"}
    for k, values in {**data, "whole": data["two"]}.items():
        want = np.quantile(values, list(PROBS.values()))
        np.testing.assert_allclose([got[k][p] for p in PROBS], want, rtol=1e-15, atol=1e-12)


def test_columns_order_odd_numbers_as_spark(spark):
    inf, nan = float("inf"), float("nan")
    df = wide_frame(spark, {"zeros": [0.0, -0.0, -0.0], "odd": [nan, -nan, inf, -inf, -1.0, 5e-324]})
    got = {r["column"]: r for r in column_quantiles(df, df.columns, {"low": 0.0, "third": 0.4, "top": 1.0}).collect()}
    assert [str(x) for x in got["zeros"][1:]] == ["0.0", "0.0", "0.0"]
    # -inf, -1, 5e-324, inf, and both NaN above all numbers.
    assert got["odd"].third == 5e-324 and np.isnan(got["odd"].top)


def test_columns_without_values(spark):
    df = spark.createDataFrame([], "a double, b int")
    got = column_quantiles(df, ["a", "b"], {"m": 0.5})
    assert got.columns == ["column", "m"] and got.count() == 0


@pytest.mark.parametrize("plan", ["describe_numbers", "column_profile", "iqr_bounds"])
def test_values_are_not_placed_among_cut_points(spark, plan, monkeypatch):
    """Neither a row per value nor a search of cut points per value: both took the time of the queries."""
    from qalathe.operators import quantiles
    from qalathe.plans import profile, validate

    def never(*args, **options):
        raise AssertionError("values are placed among cut points")

    monkeypatch.setattr(quantiles, "_count_below", never)
    df = spark.range(5).selectExpr("CAST(id AS double) AS a", "10 * id AS b")
    run = getattr(validate, plan, None) or getattr(profile, plan)
    got = {r["column"]: r for r in (run(df, ("a", "b")) if plan == "iqr_bounds" else run(df)).collect()}
    assert (got["a"].q25, got["a"].q75, got["b"].q25, got["b"].q75) == (1.0, 3.0, 10.0, 30.0)
