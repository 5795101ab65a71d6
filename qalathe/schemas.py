"""Fixed schemas of the tables that pass between stages."""

from pyspark.sql import types as T

_LONG, _STR, _DBL = T.LongType(), T.StringType(), T.DoubleType()
_WORDS = T.ArrayType(_STR)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


QUESTION_CSV_COLUMNS = (
    "Id", "Title", "Body", "Score", "AcceptedAnswerId", "Tags", "ViewCount", "CreationDate",
)
ANSWER_CSV_COLUMNS = ("AnswerId", "QuestionId", "AnswerBody", "AnswerScore")

# One landed document per tag (questions) or per batch (answers).
LANDED_QUESTIONS = _struct(
    tag=_STR,
    items=T.ArrayType(_struct(
        question_id=_LONG, accepted_answer_id=_LONG, title=_STR, body=_STR,
        tags=_WORDS, score=_LONG, view_count=_LONG,
    )),
)
LANDED_ANSWERS = _struct(
    batch=_LONG,
    items=T.ArrayType(_struct(answer_id=_LONG, body=_STR, score=_LONG)),
)

QA_PAIRS = _struct(
    question_id=_LONG, title=_STR, question_body=_STR, tags=_WORDS, score=_LONG,
    view_count=_LONG, answer_body=_STR, answer_score=_LONG,
)

TEXT_METRICS = _struct(
    char_count=_LONG, word_count=_LONG, sentence_count=_LONG, code_block_count=_LONG,
)

QA_PROCESSED = _struct(
    question_id=_LONG, title=_STR, question_body=_STR, answer_body=_STR, tags=_WORDS,
    score=_LONG, answer_score=_LONG, view_count=_LONG,
    error_signatures=_WORDS, infra_components=_WORDS, question_type=_STR, complexity=_STR,
    question_metrics=TEXT_METRICS, answer_metrics=TEXT_METRICS, quality_score=_DBL,
    processed_at=T.TimestampType(),
)

CHECKS = _struct(
    ordinal=T.IntegerType(), check=_STR, column=_STR, status=_STR, severity=_STR,
    value=_DBL, threshold=_DBL, message=_STR,
)

ALERTS = _struct(
    timestamp=T.TimestampType(), type=_STR, severity=_STR, title=_STR, message=_STR,
    details=T.MapType(_STR, _STR),
)
