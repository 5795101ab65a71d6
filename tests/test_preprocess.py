"""Records to cleaned rows."""

import datetime
import random


from qalathe import schemas as S
from qalathe.operators import best_first
from qalathe.plans import preprocess as P
from test_text import CODE, clean, random_texts

AT = datetime.datetime(2024, 5, 1)


def pairs(spark, records):
    return spark.createDataFrame(records, S.QA_PAIRS)


def record(i=1, title="T", q="How do I fix a CrashLoopBackOff in my pod?", a="word " * 20, tags=("x",),
           score=1, views=1, answer_score=1):
    return (i, title, q, None if tags is None else list(tags), score, views, a, answer_score)


def test_output_has_the_sixteen_columns(spark):
    out = P.preprocess(pairs(spark, [record()]), AT)
    assert out.columns == S.QA_PROCESSED.fieldNames()
    assert [f.dataType.simpleString() for f in out.schema] == [f.dataType.simpleString() for f in S.QA_PROCESSED]
    row = out.head()
    assert row.error_signatures == ["CrashLoopBackOff"] and row.infra_components == ["kubernetes"]
    assert row.question_type == "how_to" and row.processed_at == AT


def test_filters_and_their_reasons(spark):
    rows = [record(1), record(0), record(2, q=""), record(3, a=None), record(4, q="Hi     there  ?     "),
            record(5, a="too short"), record(6, q="x" * 20, a="y" * 50), record(None)]
    df = pairs(spark, rows)
    assert sorted(r.question_id for r in P.preprocess(df, AT).collect()) == [1, 6]
    got = {(r.reason, r.rule): r.n for r in P.drop_reasons(df).collect()}
    assert got == {("kept", "none"): 2, ("invalid_or_short", "missing_field"): 4,
                   ("invalid_or_short", "short_question"): 1, ("invalid_or_short", "short_answer"): 1}


def test_null_title_and_tags(spark):
    row = P.preprocess(pairs(spark, [record(title=None, tags=None, score=None)]), AT).head()
    assert row.title == "" and row.tags == [] and row.score == 0


def test_absent_columns(spark):
    df = spark.createDataFrame([(1, "q" * 30, "a" * 60)], "question_id long, question_body string, answer_body string")
    row = P.preprocess(df, AT).head()
    assert (row.title, row.tags, row.score, row.view_count) == ("", [], 0, 0)


def test_scores_equal_a_plain_restatement(spark):
    rng, texts = random.Random(11), random_texts(12, 400)
    rows = [record(i + 1, f"t {i}", texts[i], texts[-i], score=rng.randint(-5, 400), views=rng.randint(0, 10**6),
                   answer_score=rng.randint(-20, 300)) for i in range(1, 200)]
    want = {}
    for i, title, q, tags, score, views, a, answer_score in rows:
        if q and a and len(clean(q)) >= 20 and len(clean(a)) >= 50:
            value = (score * 2.0 + answer_score * 3.0 + views * 0.001 + min(len(q.split()) / 50, 2)
                     + min(len(a.split()) / 100, 3) + len(CODE.findall(a)) * 0.5)
            everything = f"{title} {clean(q)} {clean(a)}"
            words, blocks = len(everything.split()), len(CODE.findall(everything))
            kind = "simple" if words < 50 and not blocks else "moderate" if words < 200 or blocks <= 1 else "complex"
            want[i] = (round(value, 2), kind, clean(q), clean(a))
    got = {r.question_id: (r.quality_score, r.complexity, r.question_body, r.answer_body)
           for r in P.preprocess(pairs(spark, rows), AT).collect()}
    assert len(want) > 50 and got == want


def test_best_first_is_stable(spark):
    df = spark.range(0, 60, numPartitions=4).selectExpr("id", "id % 3 AS quality_score")
    got = [r.id for r in best_first(df.repartition(7), position="id").collect()]
    assert got == sorted(range(60), key=lambda i: -(i % 3))


def test_feature_statistics(spark):
    df = P.preprocess(pairs(spark, [record(1), record(2, tags=("x", "y"))]), AT)
    got = {(r.feature, r.value): r.n for r in P.feature_statistics(df).collect()}
    assert got[("tags", "x")] == 2 and got[("tags", "y")] == 1 and got[("quality_score", "")] == 2


def test_texts_are_cleaned_once(spark):
    plan = P.preprocess(pairs(spark, [record()]).repartition(2), AT)._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Filter" in line]
    assert conditions and not any("regexp_replace" in line for line in conditions)


def test_feature_statistics_reads_its_table_once(spark):
    from pyspark.sql import functions as F

    from qalathe.plans.preprocess import feature_statistics

    rows = spark.createDataFrame(
        [(["a", "b"], ["k"], "q1", "simple", ["t", None], 2.0), ([], ["k"], "q1", None, [], 4.0),
         (None, None, "q2", "simple", ["t"], None)],
        "error_signatures array<string>, infra_components array<string>, question_type string,"
        " complexity string, tags array<string>, quality_score double")
    out = feature_statistics(rows)
    assert out._jdf.queryExecution().analyzed().toString().count("LogicalRDD") == 1
    got = {(r.feature, r.value): (r.n, r.mean) for r in out.collect()}
    assert got == {
        ("error_signatures", "a"): (1, None), ("error_signatures", "b"): (1, None),
        ("infra_components", "k"): (2, None), ("question_type", "q1"): (2, None),
        ("question_type", "q2"): (1, None), ("complexity", "simple"): (2, None), ("tags", "t"): (2, None),
        ("quality_score", ""): (2, 3.0)}
    none = feature_statistics(rows.where(F.lit(False))).collect()
    assert [(r.feature, r.n, r.mean) for r in none] == [("quality_score", 0, None)]
