"""Oversampling, weights, split, formats."""

import hashlib

import pytest
from pyspark.sql import functions as F

from qalathe import defaults as D
from qalathe.plans import bias, training as T


def table(spark, n=200, rare=10):
    return spark.range(n).selectExpr(
        "id AS question_id", "'t' AS title", "concat('q', id) AS question_body", "concat('a', id) AS answer_body",
        f"IF(id < {rare}, array('rare', 'x'), array('x')) AS tags", "array() AS error_signatures",
        "CAST(NULL AS array<string>) AS infra_components", "CAST(id % 7 AS DOUBLE) AS quality_score",
        "IF(id < 5, 'odd', 'even') AS question_type", "'simple' AS complexity")


def urgent(spark, rows):
    return spark.createDataFrame(rows, "dimension string, value string, count long, factor_order int, strategy string, priority string")


def want(dimension, value, n=10, strategy="data_augmentation", priority="high"):
    return (dimension, value, n, 0, strategy, priority)


@pytest.mark.parametrize("rare, drawn", [(10, 20), (29, 58), (30, 0), (1, 2)])
def test_oversampling(spark, rare, drawn):
    df = table(spark, rare=rare)
    out = T.oversample(df, urgent(spark, [want("tags", "rare"), want("tags", "x", strategy="quality_filtering")])).collect()
    extra = [r for r in out if r.copy > 0]
    assert len(out) - len(extra) == 200 and len(extra) == drawn
    assert all("rare" in r.tags for r in extra) and len({r.copy for r in extra}) == drawn


def test_oversampling_takes_three_places(spark):
    df = table(spark, rare=10)
    rows = [want("question_type", "odd"), want("complexity", "c1"), want("complexity", "c2"), want("tags", "rare")]
    assert T.oversample(df, urgent(spark, rows)).count() == 200
    assert T.oversample(df, urgent(spark, rows[1:])).count() == 220
    capped = T.oversample(df, urgent(spark, rows[1:]), factor=50, cap=100)
    assert capped.count() == 300


def test_oversampling_from_a_report(spark):
    df = table(spark, n=4000, rare=10)
    report = bias.bias_report(df, min_samples=1)
    assert T.oversample(df, report["suggestions"]).count() == 4020


def test_weights(spark):
    got = {r.quality_score: r.sample_weight for r in T.quality_weights(table(spark)).collect()}
    assert got[0.0] == 0.5 and got[6.0] == 1.5 and got[3.0] == 1.0
    same = T.quality_weights(table(spark).withColumn("quality_score", F.lit(3.0)))
    assert {r.sample_weight for r in same.collect()} == {1.0}


@pytest.mark.parametrize("n, ratio", [(1000, 0.2), (999, 0.2), (7, 0.5), (1, 0.2), (10, 0.0), (10, 1.0)])
def test_split_is_exact_and_seeded(spark, n, ratio):
    df = spark.range(0, n, numPartitions=5).selectExpr("id AS question_id")
    got = {r.question_id: r.split for r in T.train_test_split(df, ratio).collect()}
    order = sorted(range(n), key=lambda i: hashlib.md5(f"{D.SPLIT_SEED}:{i}".encode()).hexdigest())
    cut = int(n * (1 - ratio))
    assert got == {i: "train" if place < cut else "test" for place, i in enumerate(order)}


@pytest.mark.parametrize("ratio", [0.1, 0.35, 0.5, 0.77])
def test_split_is_exact_among_copies(spark, ratio):
    df = spark.range(0, 3000, numPartitions=6).selectExpr("IF(id % 3 = 0, 1, id % 40) AS question_id", "id")
    out = T.train_test_split(df, ratio).collect()
    assert len({r.id for r in out}) == 3000
    assert sum(r.split == "train" for r in out) == int(3000 * (1 - ratio))


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_split_of_equal_rows_in_any_plan(spark, parts):
    df = spark.range(0, 3000, numPartitions=3).selectExpr("CAST(id % 5 AS STRING) AS question_id").repartition(parts)
    got = {(r.question_id, r.split): r["count"] for r in T.train_test_split(df, 0.7).groupBy("question_id", "split").count().collect()}
    assert sum(n for (_, split), n in got.items() if split == "train") == 900
    assert sum(got.values()) == 3000 and len(got) == 6


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_split_among_rows_of_one_key_in_any_plan(spark, parts):
    df = spark.range(0, 3000).selectExpr("id % 5 AS question_id", "id").repartition(parts)
    train = {r.id for r in T.train_test_split(df, 0.7).where("split = 'train'").collect()}
    again = {r.id for r in T.train_test_split(df.coalesce(1), 0.7).where("split = 'train'").collect()}
    assert len(train) == 900 and train == again


def test_split_of_nothing(spark):
    empty = spark.range(0).selectExpr("id AS question_id")
    assert T.train_test_split(empty).columns == ["question_id", "split"] and T.train_test_split(empty).isEmpty()


def test_split_by_stratum(spark):
    df = spark.range(0, 1000, numPartitions=4).selectExpr("id AS question_id", "IF(id < 900, 'big', IF(id < 999, 'mid', NULL)) AS s")
    got = {(r.s, r.split): r["count"] for r in T.train_test_split(df, 0.3, stratify_by="s").groupBy("s", "split").count().collect()}
    assert got == {("big", "train"): 630, ("big", "test"): 270, ("mid", "train"): 69, ("mid", "test"): 30, (None, "test"): 1}


def test_chat(spark):
    row = T.chat_examples(table(spark, 1)).head()
    assert [(m.role, m.content) for m in row.messages] == [
        ("system", D.SYSTEM_PROMPT), ("user", "q0"), ("assistant", "a0")]
    assert row.metadata.sample_weight == 1.0 and row.metadata.tags == ["rare", "x"]
    short = T.chat_examples(table(spark, 1), system_prompt=None, weighted=False).head()
    assert [m.role for m in short.messages] == ["user", "assistant"] and "sample_weight" not in short.metadata


def test_completion(spark):
    row = T.completion_examples(table(spark, 1)).head()
    assert row.prompt == "### Question\nt\n\nq0\n\nTags: rare, x\n\n### Answer\n" and row.completion == "a0"


def test_options_and_statistics(spark):
    df, rows = table(spark), urgent(spark, [want("tags", "rare")])
    stats = T.training_statistics(T.training_rows(df, rows)).head()
    assert (stats.input_records, stats.after_resampling, stats.train_examples, stats.test_examples) == (200, 220, 176, 44)
    plain = T.training_statistics(T.training_rows(df, rows, apply_mitigation=False, test_ratio=0.5)).head()
    assert (plain.after_resampling, plain.train_examples) == (200, 100)
    assert T.train_tag_frequency(T.training_rows(df), 1).head().value == "x"
    with pytest.raises(ValueError):
        T.training_examples(df, "table")


def test_split_over_many_strata(spark):
    df = spark.range(0, 3000, numPartitions=4).selectExpr("id AS question_id", "IF(id % 3 = 0, 0, id % 60) AS s")
    got = {(r.s, r.split): r["count"] for r in T.train_test_split(df, 0.25, stratify_by="s").groupBy("s", "split").count().collect()}
    sizes = {}
    for i in range(3000):
        s = 0 if i % 3 == 0 else i % 60
        sizes[s] = sizes.get(s, 0) + 1
    for s, n in sizes.items():
        assert got[(s, "train")] == int(n * 0.75) and got.get((s, "test"), 0) == n - int(n * 0.75)
