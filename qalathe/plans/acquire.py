"""Questions and answers from dumps to one row per answered question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions import clean_html, int_or_zero, strict_int, tag_list
from ..operators import beside, first_per_key, last_per_key, unique_lookup_join
from ..operators.lookup import HOT_ROWS


def wellformed_questions(raw: DataFrame, min_score: int = D.MIN_SCORE) -> DataFrame:
    """Text rows as typed questions: well-voted, with an accepted answer, all numbers readable.

    Titles and bodies stay raw; they are cleaned after the join, on the rows that are left.
    """
    accepted = F.trim(F.coalesce("AcceptedAnswerId", F.lit("")))
    typed = raw.where((int_or_zero("Score") >= min_score) & (accepted != "")).select(
        strict_int("Id").alias("question_id"),
        F.col("Title").alias("title"),
        F.col("Body").alias("body"),
        int_or_zero("Score").alias("score"),
        strict_int("AcceptedAnswerId").alias("accepted_answer_id"),
        tag_list("Tags").alias("tags"),
        int_or_zero("ViewCount").alias("view_count"),
        F.col("CreationDate").alias("creation_date"),
    )
    return typed.where(
        F.col("question_id").isNotNull() & F.col("accepted_answer_id").isNotNull()
        & F.col("view_count").isNotNull()
    )


def wellformed_answers(raw: DataFrame, position: str = "_pos") -> DataFrame:
    """Text rows as typed answers with non-zero ids and readable numbers."""
    typed = raw.select(
        int_or_zero("AnswerId").alias("answer_id"),
        int_or_zero("QuestionId").alias("question_id"),
        F.col("AnswerBody").alias("body"),
        int_or_zero("AnswerScore").alias("score"),
        F.col(position).alias("_pos"),
    )
    return typed.where(
        (F.col("answer_id") != 0) & (F.col("question_id") != 0) & F.col("score").isNotNull()
    )


def _pair_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "question_id",
        clean_html("title").alias("title"),
        clean_html("body").alias("question_body"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("score", F.lit(0)).cast("long").alias("score"),
        F.coalesce("view_count", F.lit(0)).cast("long").alias("view_count"),
        clean_html("_answer_body").alias("answer_body"),
        F.coalesce("_answer_score", F.lit(0)).cast("long").alias("answer_score"),
    )


def pairs_by_question(
    questions: DataFrame, answers: DataFrame, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dump form: each question with the last answer that names it."""
    lookup = last_per_key(answers, "question_id").select(
        "question_id", F.col("body").alias("_answer_body"), F.col("score").alias("_answer_score"))
    return _pair_columns(unique_lookup_join(questions, lookup, "question_id", hot_rows))


def distinct_landed_questions(items: DataFrame) -> DataFrame:
    """First meeting of each question that has an accepted answer."""
    answered = items.where(F.coalesce("accepted_answer_id", F.lit(0)) != 0)
    return first_per_key(answered, "question_id")


def distinct_landed_answers(items: DataFrame) -> DataFrame:
    """Last meeting of each answer."""
    return last_per_key(items, "answer_id")


def pairs_by_accepted_answer(
    questions: DataFrame, answers: DataFrame, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Landed form: each question with its accepted answer, both already distinct."""
    lookup = answers.select(
        F.col("answer_id").alias("accepted_answer_id"),
        F.col("body").alias("_answer_body"), F.col("score").alias("_answer_score"))
    return _pair_columns(unique_lookup_join(questions, lookup, "accepted_answer_id", hot_rows))


def acquire_pairs(questions: DataFrame, answers: DataFrame, path: str) -> DataFrame:
    """Writes the pairs of ``questions`` and ``answers`` to ``path``; one row of the counts
    (questions loaded, pairs matched), observed while that one write runs, without another pass."""
    from pyspark.sql import Observation

    from ..sources import write_table

    loaded, matched = Observation("questions_loaded"), Observation("answers_matched")
    seen = questions.observe(loaded, F.count(F.lit(1)).alias("n"))
    pairs = pairs_by_question(seen, answers).observe(matched, F.count(F.lit(1)).alias("n"))
    write_table(pairs, path)
    spark = questions.sparkSession
    return spark.createDataFrame([(loaded.get["n"], matched.get["n"])], "questions_loaded long, answers_matched long")


def acquisition_counts(questions: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: questions loaded and pairs matched."""
    loaded = questions.agg(F.count(F.lit(1)).alias("questions_loaded"))
    matched = pairs.agg(F.count(F.lit(1)).alias("answers_matched"))
    return beside(loaded, matched)
