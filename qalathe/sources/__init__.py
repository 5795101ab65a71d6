"""Readers and writers of the stage tables."""

from .readers import (  # noqa: F401
    first_available,
    landed_answers,
    landed_question_documents,
    landed_questions,
    optional_json,
    read_answers_csv,
    read_answers_csv_split,
    read_json_array,
    read_json_items,
    read_questions_csv,
    read_questions_csv_split,
)
from .writers import (  # noqa: F401
    flat_for_csv,
    write_csv,
    write_json,
    write_jsonl,
    write_table,
)
