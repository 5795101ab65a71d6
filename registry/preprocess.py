"""Cleaning, features and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalathe import functions as fx
from qalathe.operators import best_first
from qalathe.plans import preprocess as plan

from . import working as W
from .working import given, given_wide, qa_base, qa_processed, stage_table


def _joined(c: str):
    return F.concat_ws("|", c).alias(c)


def minimum_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, score and group by question type: the flagship query."""
    return qa_processed(spark, sf_dir).groupBy("question_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("quality_score"), 6).alias("avg_quality"),
        F.max("quality_score").alias("max_quality"),
        F.sum("question_metrics.word_count").alias("question_words"),
        F.sum("answer_metrics.code_block_count").alias("answer_code_blocks"),
    )


def processed_records(spark, sf_dir):
    out = qa_processed(spark, sf_dir)
    metrics = [
        F.col(f"{side}_metrics.{m}").alias(f"{side}_{m}")
        for side in ("question", "answer")
        for m in ("char_count", "word_count", "sentence_count", "code_block_count")
    ]
    return out.select(
        "question_id", "title", F.md5("question_body").alias("question_md5"),
        F.md5("answer_body").alias("answer_md5"), _joined("tags"), "score", "answer_score",
        "view_count", _joined("error_signatures"), _joined("infra_components"),
        "question_type", "complexity", *metrics, "quality_score",
    )


def dropped_rows(spark, sf_dir):
    return plan.drop_reasons(qa_base(spark, sf_dir))


def best_pairs_first(spark, sf_dir):
    """The sorted table as it is read back: its rank is its place in the files."""
    table = stage_table(spark, best_first(qa_processed(spark, sf_dir)).select("question_id", "quality_score"), "sorted")
    rows = table.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = rows.groupBy("file").agg(F.count("*").alias("n"))  # few
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(files.select("file", before.alias("before")), "file").select(
        "question_id", "quality_score", (F.col("before") + F.col("row") + 1).alias("rank"))


def feature_statistics(spark, sf_dir):
    out = plan.feature_statistics(qa_processed(spark, sf_dir))
    return out.select("feature", "value", "n", F.round("mean", 6).alias("mean"))


def squeezed_text(spark, sf_dir):
    docs = given_wide(spark, sf_dir, "documents", "doc_id", "text")
    text = fx.squeeze("text")
    return docs.select("doc_id", F.md5(text).alias("text_md5"),
                       fx.word_count("text").alias("words"),
                       fx.is_blank("text").alias("is_blank"))


def code_extraction(spark, sf_dir):
    base = qa_base(spark, sf_dir)
    blocks = fx.code_blocks("question_body")
    return base.select(
        "question_id", F.size(blocks).cast("long").alias("n_blocks"),
        F.concat_ws("|", blocks).alias("blocks"),
        F.md5(fx.replace_code("question_body")).alias("replaced_md5"),
        F.md5(fx.clean_text("question_body", remove_code=True)).alias("removed_md5"),
        F.md5(fx.clean_text("question_body")).alias("kept_md5"),
    )


def text_measures(spark, sf_dir):
    m = fx.text_metrics("text")
    return given_wide(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", m.alias("m")).select("doc_id", "m.*")


def label_counts(spark, sf_dir):
    base = qa_base(spark, sf_dir)
    return base.select(
        "question_id", F.concat_ws("|", fx.error_signatures("question_body")).alias("errors"),
        F.concat_ws("|", fx.infra_components("question_body")).alias("infra"),
        fx.question_type("question_body").alias("question_type"),
        fx.complexity_class("question_body").alias("complexity"),
        fx.comma_joined("tags").alias("tag_text"),
    )


def cleaned_pages(spark, sf_dir):
    pages = given_wide(spark, sf_dir, "pages").withColumn("clean", fx.clean_html("html"))
    return pages.select("page_id", F.md5("clean").alias("clean_md5"),
                        F.length("clean").cast("long").alias("clean_chars"),
                        F.md5(fx.clean_html("url")).alias("url_md5"))


def absent_columns_filled(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("question_id"), F.col("text").alias("question_body"))
    out = plan.with_defaults(docs)
    return out.select("question_id", "title", F.md5("question_body").alias("question_md5"),
                      "answer_body", F.size("tags").cast("long").alias("n_tags"),
                      "score", "answer_score", "view_count")


QUERIES = {
    "question_type_quality": minimum_slice,
    "processed_records": processed_records,
    "dropped_rows_by_rule": dropped_rows,
    "best_pairs_first": best_pairs_first,
    "feature_statistics": feature_statistics,
    "squeezed_text": squeezed_text,
    "code_extraction": code_extraction,
    "text_measures": text_measures,
    "labels_and_classes": label_counts,
    "cleaned_pages": cleaned_pages,
    "absent_columns_filled": absent_columns_filled,
}

_SQUEEZE = r"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'))"


def _squeeze(c: str) -> str:
    return _SQUEEZE.format(c=c)


_TAGS_GONE = r"regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g')"


def _page_text(c: str) -> str:
    out = _TAGS_GONE.format(c=c)
    # These names are also entities without their semicolon, which some pages have.
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        out = f"regexp_replace({out}, '&{name};?', '{char}', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


_METRICS = ", ".join(
    f"{expr} AS {side}_{name}"
    for side in ("question", "answer")
    for name, expr in (
        ("char_count", f"CAST(length({side}_body) AS BIGINT)"),
        ("word_count", W.words(f"{side}_body")),
        ("sentence_count", W.sentences(f"{side}_body")),
        ("code_block_count", W.code_spans(f"{side}_body")),
    )
)

ORACLE = {
    "question_type_quality": W.with_qa(f"""
SELECT question_type, count(*) AS n, round(avg(quality_score), 6) AS avg_quality,
       max(quality_score) AS max_quality,
       CAST(sum({W.words('question_body')}) AS BIGINT) AS question_words,
       CAST(sum({W.code_spans('answer_body')}) AS BIGINT) AS answer_code_blocks
FROM qa GROUP BY question_type"""),
    "processed_records": W.with_qa(f"""
SELECT question_id, title, md5(question_body) AS question_md5, md5(answer_body) AS answer_md5,
       array_to_string(tags, '|') AS tags, score, answer_score, view_count,
       array_to_string(error_signatures, '|') AS error_signatures,
       array_to_string(infra_components, '|') AS infra_components,
       question_type, complexity, {_METRICS}, quality_score
FROM qa"""),
    "dropped_rows_by_rule": f"""
WITH {W.QA_CTE},
judged AS (
  SELECT CASE WHEN question_id = 0 OR length(coalesce(question_body, '')) = 0
                OR length(coalesce(answer_body, '')) = 0 THEN 'missing_field'
              WHEN length({W._clean('question_body')}) < 20 THEN 'short_question'
              WHEN length({W._clean('answer_body')}) < 50 THEN 'short_answer' ELSE 'none' END AS rule
  FROM qa_base)
SELECT CASE WHEN rule = 'none' THEN 'kept' ELSE 'invalid_or_short' END AS reason, rule, count(*) AS n
FROM judged GROUP BY ALL""",
    "best_pairs_first": W.with_qa(
        "SELECT question_id, quality_score, row_number() OVER (ORDER BY quality_score DESC, question_id) AS rank FROM qa"),
    "feature_statistics": W.with_qa("""
SELECT feature, value, count(*) AS n, CAST(NULL AS DOUBLE) AS mean
FROM (SELECT 'error_signatures' AS feature, unnest(error_signatures) AS value FROM qa
      UNION ALL SELECT 'infra_components', unnest(infra_components) FROM qa
      UNION ALL SELECT 'tags', unnest(tags) FROM qa
      UNION ALL SELECT 'question_type', question_type FROM qa
      UNION ALL SELECT 'complexity', complexity FROM qa) GROUP BY feature, value
UNION ALL
SELECT 'quality_score', '', count(quality_score), round(avg(quality_score), 6) FROM qa"""),
    "squeezed_text": f"""
SELECT doc_id, md5({_squeeze('text')}) AS text_md5, {W.words('text')} AS words,
       regexp_full_match(text, '\\s*') AS is_blank FROM documents""",
    "code_extraction": f"""
WITH qa_base AS ({W.QA_BASE_SQL})
SELECT question_id, {W.code_spans('question_body')} AS n_blocks,
       array_to_string(regexp_extract_all(question_body, '{W.CODE}'), '|') AS blocks,
       md5({_squeeze(f"regexp_replace(question_body, '{W.CODE}', ' [CODE] ', 'g')")}) AS replaced_md5,
       md5({_squeeze("regexp_replace(regexp_replace(regexp_replace(question_body,"
                     " 'https?://[^\\s]+', '[URL]', 'g'), '```[\\s\\S]*?```', '', 'g'), '`[^`]+`', '', 'g')")})
         AS removed_md5,
       md5({W._clean('question_body')}) AS kept_md5
FROM qa_base""",
    "text_measures": f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, {W.words('text')} AS word_count,
       {W.sentences('text')} AS sentence_count, {W.code_spans('text')} AS code_block_count
FROM documents""",
    "labels_and_classes": f"""
WITH qa_base AS ({W.QA_BASE_SQL})
SELECT question_id, array_to_string({W.labels_sql('question_body', W.ERROR_PATTERNS)}, '|') AS errors,
       array_to_string({W.labels_sql('question_body', W.INFRA_PATTERNS)}, '|') AS infra,
       {W.type_sql('question_body')} AS question_type, {W.complexity_sql('question_body')} AS complexity,
       lang || ', ' || source AS tag_text
FROM qa_base""",
    "cleaned_pages": f"""
SELECT page_id, md5({_page_text('html')}) AS clean_md5,
       CAST(length({_page_text('html')}) AS BIGINT) AS clean_chars, md5({_page_text('url')}) AS url_md5
FROM pages""",
    "absent_columns_filled": """
SELECT doc_id + 1 AS question_id, '' AS title, md5(text) AS question_md5, '' AS answer_body,
       CAST(0 AS BIGINT) AS n_tags, CAST(0 AS BIGINT) AS score, CAST(0 AS BIGINT) AS answer_score,
       CAST(0 AS BIGINT) AS view_count FROM documents""",
}

COVERS = {
    "question_type_quality": ("P5", "P6", "P7", "P8", "F7", "A15"),
    "processed_records": ("P5", "P6", "P7", "P8", "F5", "F6", "F7", "F8", "F9", "F10", "F11"),
    "dropped_rows_by_rule": ("P12",),
    "best_pairs_first": ("O1",),
    "feature_statistics": ("A24",),
    "squeezed_text": ("F3",),
    "code_extraction": ("F4", "F5"),
    "text_measures": ("F6",),
    "labels_and_classes": ("F8", "F9", "F10", "F11", "F14"),
    "cleaned_pages": ("F1",),
    "absent_columns_filled": ("P10",),
}
