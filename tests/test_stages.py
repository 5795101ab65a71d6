"""The chain from pairs to training sets, and the tables it leaves."""

import datetime
import json

import pytest

from qalathe import schemas as S
from qalathe.plans.stages import run_from_csv, run_from_landed, run_stages
from qalathe.plans.validate import read_validated

AT = datetime.datetime(2024, 5, 1)


def pairs(spark, n):
    rows = [(i + 1, f"Title {i}", f"How do I fix the timeout of pod {i} in kubernetes?", ["kubernetes", f"t{i % 4}"],
             i % 50, i * 10, f"Look at the logs of pod {i}, then raise the limit. " * (2 + i % 3), i % 30) for i in range(n)]
    return spark.createDataFrame(rows, S.QA_PAIRS)


@pytest.mark.parametrize("n, valid, output_format", [(150, True, "chat"), (20, False, "completion")])
def test_chain(spark, tmp_path, n, valid, output_format):
    place = run_stages(spark, pairs(spark, n), str(tmp_path), AT, output_format=output_format, min_samples=1)
    assert spark.read.parquet(place["processed"]).count() == n
    assert (tmp_path / "validated").exists() == valid
    cut = int(n * 0.8)
    train = spark.read.json(place["train"])
    assert train.count() == cut and spark.read.json(place["test"]).count() == n - cut
    assert ("messages" if output_format == "chat" else "prompt") in train.columns
    kinds = {r.type for r in spark.read.json(place["alerts"]).collect()}
    assert ("validation_failure" in kinds) != valid
    summary = spark.read.json(place["summary"]).head()
    assert (summary.records_acquired, summary.records_processed, summary.training_examples) == (n, n, n)
    assert spark.read.csv(place["processed_csv"], header=True, multiLine=True, escape='"').count() == n
    assert spark.read.json(place["expectations"]).count() == 10


def test_a_rerun_follows_its_own_verdict(spark, tmp_path):
    run_stages(spark, pairs(spark, 150), str(tmp_path), AT, min_samples=1)
    place = run_stages(spark, pairs(spark, 20), str(tmp_path), AT + datetime.timedelta(days=1), min_samples=1, max_rows=None)
    assert spark.read.parquet(place["training_rows"]).count() == 20
    assert read_validated(spark, place["validated"]).count() == 150
    first, second = (spark.read.parquet(f"{place['history']}/{k}/rows").count() for k in (0, 1))
    assert second == first + spark.read.json(place["alerts"]).select("timestamp", "type", "title").distinct().count()
    for name in ("text_statistics", "categories", "tags", "common_texts", "dataset_info", "feature_statistics",
                 "shares", "bias_metrics"):
        assert spark.read.json(place[name]).count() > 0, name


def test_chain_from_csv(spark, tmp_path):
    questions = ["Id,Title,Body,Score,AcceptedAnswerId,Tags,ViewCount,CreationDate"]
    answers = ["AnswerId,QuestionId,AnswerBody,AnswerScore"]
    for i in range(1, 11):
        questions.append(f'{i},T{i},"<p>Why is pod {i} crashing, and how do I stop it?</p>",{i},{i + 100},<a><b>,5,')
        answers.append(f'{i + 100},{i},"Look at the logs, &amp; then raise the limit of pod {i} a bit.",3')
    (tmp_path / "q.csv").write_text("\n".join(questions))
    (tmp_path / "a.csv").write_text("\n".join(answers))
    place = run_from_csv(spark, str(tmp_path / "q.csv"), str(tmp_path / "a.csv"), str(tmp_path / "out"), AT, min_rows=1)
    rows = spark.read.parquet(place["processed"]).collect()
    assert sorted(r.question_id for r in rows) == [5, 6, 7, 8, 9, 10]
    assert all("& then" in r.answer_body and r.tags == ["a", "b"] for r in rows)
    assert spark.read.json(place["train"]).count() == 4


def test_chain_from_landed_responses(spark, tmp_path):
    asked = [{"question_id": i, "accepted_answer_id": i + 100 if i != 3 else None, "title": f"T{i}", "tags": ["a"], "score": i,
              "view_count": 5, "body": f"<p>Why is pod {i} crashing, and how do I stop it?</p>"} for i in range(1, 7)]
    said = [{"answer_id": i + 100, "score": 3, "body": f"Look at the logs, &amp; then raise the limit of pod {i} a bit."}
            for i in range(1, 6)]
    for name, pages in (("q", [{"tag": "a", "items": asked}, {"tag": "b", "items": asked[:2]}]), ("a", [{"batch": 1, "items": said}])):
        (tmp_path / name).mkdir()
        for k, page in enumerate(pages):
            (tmp_path / name / f"{k}.json").write_text(json.dumps(page, indent=1))
    place = run_from_landed(spark, str(tmp_path / "q"), str(tmp_path / "a"), str(tmp_path / "out"), AT, min_rows=1)
    rows = spark.read.parquet(place["processed"]).collect()
    assert sorted(r.question_id for r in rows) == [1, 2, 4, 5]
    assert all("& then" in r.answer_body for r in rows)
