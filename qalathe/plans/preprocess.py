"""Pairs to cleaned rows with features and a quality score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions import (
    clean_text,
    first_matching_group,
    fold_case,
    labels_found,
    quality_score,
    text_metrics,
)
from ..functions.features import complexity_from_counts
from ..functions.text import code_block_count, word_count


def with_defaults(pairs: DataFrame) -> DataFrame:
    """All pair columns, absent or null ones filled with 0, '' or []."""
    have = set(pairs.columns)

    def filled(name: str, kind: str, empty: Column) -> Column:
        c = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        return F.coalesce(c, empty.cast(kind)).alias(name)

    return pairs.select(
        filled("question_id", "bigint", F.lit(0)),
        filled("title", "string", F.lit("")),
        filled("question_body", "string", F.lit("")),
        filled("answer_body", "string", F.lit("")),
        filled("tags", "array<string>", F.array()),
        filled("score", "bigint", F.lit(0)),
        filled("answer_score", "bigint", F.lit(0)),
        filled("view_count", "bigint", F.lit(0)),
    )


def _complete() -> Column:
    return (
        (F.col("question_id") != 0)
        & (F.col("question_body") != "") & (F.col("answer_body") != "")
    )


def _cleaned(pairs: DataFrame) -> DataFrame:
    """Adds the cleaned texts ``_question`` and ``_answer``.

    They come out of a one-element generator: a plain projection would let the optimizer push
    the length filter below it and so clean every text twice.
    """
    texts = F.struct(
        clean_text("question_body").alias("_question"), clean_text("answer_body").alias("_answer"))
    return with_defaults(pairs).select("*", F.inline(F.array(texts)))


def long_enough(
    pairs: DataFrame, min_question: int = D.MIN_QUESTION_CHARS, min_answer: int = D.MIN_ANSWER_CHARS,
) -> DataFrame:
    """Complete pairs whose cleaned texts reach the minimum lengths, texts in ``_question`` and
    ``_answer``."""
    return _cleaned(pairs).where(_complete()).where(
        (F.length("_question") >= min_question) & (F.length("_answer") >= min_answer))


def preprocess(
    pairs: DataFrame, processed_at=None,
    error_lexicon=None, infra_lexicon=None, question_types=None,
    min_question: int = D.MIN_QUESTION_CHARS, min_answer: int = D.MIN_ANSWER_CHARS,
) -> DataFrame:
    """Cleaned pairs with labels, type, complexity, text metrics and score: 16 columns.

    Texts are cleaned and measured once, in layers of their own, and every later expression
    reads those columns. Words are counted on the cleaned texts: replacing a link and
    squeezing white space change no word count. Code spans of the score are counted on the raw
    answer, where a link may hold back-ticks.
    """
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    kept = long_enough(pairs, min_question, min_answer)
    measured = kept.withColumns({
        "_q": text_metrics("_question", squeezed=True),
        "_a": text_metrics("_answer", squeezed=True),
        "_all": F.concat_ws(" ", "title", "_question", "_answer"),
        "_lower": F.lower("_question"),
    }).withColumn("_folded", fold_case("_all"))
    title_words = word_count("title")
    return measured.select(
        "question_id",
        clean_text("title").alias("title"),
        F.col("_question").alias("question_body"),
        F.col("_answer").alias("answer_body"),
        "tags", "score", "answer_score", "view_count",
        labels_found("_folded", D.ERROR_LEXICON if error_lexicon is None else error_lexicon)
        .alias("error_signatures"),
        labels_found("_folded", D.INFRA_LEXICON if infra_lexicon is None else infra_lexicon)
        .alias("infra_components"),
        first_matching_group(
            "_lower", D.QUESTION_TYPES if question_types is None else question_types,
            D.OTHER_QUESTION_TYPE,
        ).alias("question_type"),
        complexity_from_counts(
            title_words + F.col("_q.word_count") + F.col("_a.word_count"),
            code_block_count("_all"),
        ).alias("complexity"),
        F.col("_q").alias("question_metrics"),
        F.col("_a").alias("answer_metrics"),
        quality_score(
            "score", "answer_score", "view_count",
            F.col("_q.word_count"), F.col("_a.word_count"), code_block_count("answer_body"),
        ).alias("quality_score"),
        stamp.alias("processed_at"),
    )


def drop_reasons(
    pairs: DataFrame, min_question: int = D.MIN_QUESTION_CHARS, min_answer: int = D.MIN_ANSWER_CHARS,
) -> DataFrame:
    """Rows per outcome: ``kept`` or ``invalid_or_short``, with the rule that dropped them."""
    rule = (
        F.when(~_complete(), "missing_field")
        .when(F.length("_question") < min_question, "short_question")
        .when(F.length("_answer") < min_answer, "short_answer")
    )
    return (
        _cleaned(pairs).select(rule.alias("rule"))
        .groupBy(
            F.when(F.col("rule").isNull(), "kept").otherwise("invalid_or_short").alias("reason"),
            F.coalesce("rule", F.lit("none")).alias("rule"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def feature_statistics(processed: DataFrame) -> DataFrame:
    """Mean quality and the five frequency tables as rows ``(feature, value, n, mean)``."""
    features = F.array(*[
        F.struct(F.lit(c).alias("feature"), values.alias("values"))
        for c, values in (
            ("error_signatures", F.col("error_signatures")),
            ("infra_components", F.col("infra_components")),
            ("question_type", F.array("question_type")),
            ("complexity", F.array("complexity")),
            ("tags", F.col("tags")),
            ("quality_score", F.array(F.lit(""))),
        )
    ])
    # One pass: the score's row is a group beside the others. It is there for an empty table too.
    rows = (
        processed.select("quality_score", F.inline(features))
        .select("feature", F.explode("values").alias("value"),
                F.when(F.col("feature") == "quality_score", F.col("quality_score")).alias("score"))
        .where(F.col("value").isNotNull())
    )
    always = processed.sparkSession.range(1).select(
        F.lit("quality_score").alias("feature"), F.lit("").alias("value"), F.lit(None).cast("double").alias("score"))
    return (
        rows.unionByName(always).groupBy("feature", "value")
        .agg(F.when(F.col("feature") == "quality_score", F.count("score")).otherwise(F.count(F.lit(1))).alias("n"),
             F.avg("score").alias("mean"))
    )
