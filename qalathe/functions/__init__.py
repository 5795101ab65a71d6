"""Column expressions used inside the table jobs."""

from .features import (  # noqa: F401
    comma_joined,
    complexity_class,
    error_signatures,
    first_matching_group,
    fold_case,
    infra_components,
    labels_found,
    quality_score,
    question_type,
)
from .html import clean_html, has_leftover_tags, tag_list  # noqa: F401
from .numeric import int_or_zero, python_round, strict_int  # noqa: F401
from .text import (  # noqa: F401
    clean_text,
    code_blocks,
    is_blank,
    replace_code,
    squeeze,
    text_metrics,
    word_count,
)
