"""Scans, lookups and joins, on the awkward inputs a dump may hold."""

import json

import pytest

from qalathe import schemas as S
from qalathe import sources
from qalathe.operators import duplicate_flags, first_per_key, last_per_key, unique_lookup_join
from qalathe.plans import acquire as A

QUESTIONS = (
    b'Id,Title,Body,Score,AcceptedAnswerId,Tags,ViewCount,CreationDate\n'
    b'1,"T ""one""","<p>line\nbreak</p>",5,11,<a><b>,7,2024\n'
    b'2,T2,bad \xff byte,9,12,,,\n'
    b'3,low score,b,4,13,<a>,1,\n'
    b'4,no accepted,b,9, ,<a>,1,\n'
    b'x,bad id,b,9,14,<a>,1,\n'
    b'5,bad views,b,9,15,<a>,many,\n'
    b'6,short row,b,9,16\n'
    b'7,blank score,b,,17,<a>,1,\n'
)
ANSWERS = (
    b'AnswerId,QuestionId,AnswerBody,AnswerScore\n'
    b'11,1,first,1\n'
    b'21,1,"second\n&amp; last",2\n'
    b'12,2,only,\n'
    b'0,2,zero id,5\n'
    b'16,6,bad score,x\n'
)


@pytest.fixture()
def dump(tmp_path):
    (tmp_path / "q.csv").write_bytes(QUESTIONS)
    (tmp_path / "a.csv").write_bytes(ANSWERS)
    return str(tmp_path / "q.csv"), str(tmp_path / "a.csv")


def test_csv_dump(spark, dump):
    questions = A.wellformed_questions(sources.read_questions_csv(spark, dump[0]))
    got = {r.question_id: r for r in questions.collect()}
    assert set(got) == {1, 2, 6}
    assert got[1].title == 'T "one"' and got[1].tags == ["a", "b"] and got[1].view_count == 7
    assert got[2].body == "bad � byte" and got[2].tags == [] and got[2].view_count == 0
    answers = A.wellformed_answers(sources.read_answers_csv(spark, dump[1]))
    pairs = {r.question_id: r for r in A.pairs_by_question(questions, answers).collect()}
    assert set(pairs) == {1, 2}
    assert pairs[1].answer_body == "second & last" and pairs[1].answer_score == 2
    assert pairs[1].question_body == "line break" and pairs[2].answer_score == 0
    assert pairs[1].asDict().keys() == set(S.QA_PAIRS.fieldNames())
    counts = A.acquisition_counts(questions, A.pairs_by_question(questions, answers)).head()
    assert (counts.questions_loaded, counts.answers_matched) == (3, 2)


def test_csv_columns_found_by_name(spark, tmp_path):
    (tmp_path / "q.csv").write_text("Score,Id,AcceptedAnswerId\n8,1,2\n")
    row = A.wellformed_questions(sources.read_questions_csv(spark, str(tmp_path / "q.csv"))).head()
    assert (row.question_id, row.score, row.title, row.tags, row.view_count) == (1, 8, None, [], 0)


def test_last_file_wins(spark, tmp_path):
    for name, body in (("a1.csv", "old" * 1000), ("a2.csv", "new")):
        (tmp_path / name).write_text(f"AnswerId,QuestionId,AnswerBody,AnswerScore\n1,1,{body},1\n")
    answers = A.wellformed_answers(sources.read_answers_csv(spark, str(tmp_path)))
    assert last_per_key(answers, "question_id").head().body == "new"
    assert first_per_key(answers, "question_id").head().body == "old" * 1000


def test_landed_responses(spark, tmp_path):
    def item(q, a, title):
        return {"question_id": q, "accepted_answer_id": a, "title": title, "body": "<p>b</p>", "tags": ["t"],
                "score": 1, "view_count": 2}

    (tmp_path / "q").mkdir()
    (tmp_path / "a").mkdir()
    pages = {"2": ("gpu", [item(1, 5, "later"), item(2, None, "unanswered"), item(3, 6, "x")]),
             "1": ("kubernetes", [item(1, 5, "earlier"), item(4, 0, "zero"), item(5, 99, "no answer")]),
             "0": ("other", [item(3, 7, "unlisted tag")])}
    for name, (tag, items) in pages.items():
        (tmp_path / "q" / f"{name}.json").write_text(json.dumps({"tag": tag, "items": items}, indent=2))
    batches = [[{"answer_id": 5, "body": "a1", "score": 1}], [{"answer_id": 5, "body": "a2", "score": 2}, {"answer_id": 6}]]
    for i, items in enumerate(batches):
        (tmp_path / "a" / f"{i}.json").write_text(json.dumps({"batch": i, "items": items}))
    questions = A.distinct_landed_questions(sources.landed_questions(spark, str(tmp_path / "q")))
    assert {r.question_id: r.title for r in questions.collect()} == {1: "earlier", 3: "x", 5: "no answer"}
    answers = A.distinct_landed_answers(sources.landed_answers(spark, str(tmp_path / "a")))
    pairs = {r.question_id: r for r in A.pairs_by_accepted_answer(questions, answers).collect()}
    assert {q: (r.answer_body, r.answer_score) for q, r in pairs.items()} == {1: ("a2", 2), 3: ("", 0)}


def test_json_array_file(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"question_id": 1, "tags": ["a"]}, {"question_id": 2}], indent=1))
    rows = sources.read_json_array(spark, str(tmp_path / "t.json"), S.QA_PAIRS).collect()
    assert [(r.question_id, r.tags) for r in rows] == [(1, ["a"]), (2, None)]


def test_fallback_and_optional(spark, tmp_path):
    good = str(tmp_path / "good")
    sources.write_table(spark.range(3), good)
    assert sources.first_available(spark, str(tmp_path / "none"), good).count() == 3
    with pytest.raises(FileNotFoundError):
        sources.first_available(spark, str(tmp_path / "none"))
    assert sources.optional_json(spark, str(tmp_path / "none"), S.CHECKS) is None


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ' a "b"\nc, ', ["x", "y"], {"k": 1}), (2, None, [], None)], "id long, t string, l array<string>, m map<string,int>")
    path = str(tmp_path / "out")
    sources.write_csv(df, path)
    back = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", ' a "b"\nc, ', '["x","y"]', '{"k":1}'), ("2", None, "[]", None)]


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_lookup_join_with_a_hot_key(spark, hot_rows):
    rows = spark.range(0, 3000, numPartitions=7).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS payload")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "k long, payload long"))
    lookup = spark.range(0, 2000).selectExpr("id AS k", "id * 10 AS found")
    got = unique_lookup_join(rows, lookup, "k", hot_rows, fan_out=5).collect()
    want = [(1 if i % 3 == 0 else i, i) for i in range(3000)]
    assert sorted((r.k, r.payload) for r in got) == sorted(w for w in want if w[0] < 2000)
    assert all(r.found == r.k * 10 for r in got)


def test_keep_first_flags(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4), (2, 5), (1, 6)], "k int, p int")
    got = {r.p: r.is_duplicate for r in duplicate_flags(rows, "k", "p").collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False, 6: True}


def test_counts_observed_in_the_write(spark, tmp_path):
    from registry import acquire as R
    from registry.working import given

    sf = "/root/testdata/sf0.001"
    questions, answers = R._questions(spark, sf), R._answers(spark, sf)
    path = str(tmp_path / "pairs")
    counts = A.acquire_pairs(questions, answers, path).first()
    written = spark.read.parquet(path)
    assert counts.answers_matched == written.count() == A.pairs_by_question(questions, answers).count()
    assert counts.questions_loaded == questions.count() and given(spark, sf, "documents").count() > 0
