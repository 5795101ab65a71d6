"""Resampling, weights, split and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalathe.plans import bias
from qalathe.plans import training as plan
from qalathe.plans.stages import run_summary

from . import working as W
from .validate import _rounded
from .working import given, given_wide, qa_base, qa_processed, qa_stage, stage_table


def _urgent(table):
    """Suggestions under limits that call the smallest slices under-represented."""
    arrays = {"infra_components": "infra_"}
    slices = bias.slice_metrics(table, 1, scalars=("question_type",), arrays=arrays, median=False)
    found = bias.bias_verdicts(
        slices, bias.overall_metrics(table, median=False), min_proportion=0.2, min_count=10_000_000)
    return bias.suggestions(found, high_priority_count=10_000_000)


def _resampled(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    urgent = stage_table(spark, _urgent(table), "suggestions")
    return plan.oversample(table, urgent, max_slices=30, small=5_000)


def resampled_counts(spark, sf_dir):
    return _resampled(spark, sf_dir).groupBy("copy").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("copy") > 0, F.col("question_id")).otherwise(0)).alias("drawn_id"))


def weights(spark, sf_dir):
    return _rounded(plan.quality_weights(qa_stage(spark, sf_dir)).select("question_id", "sample_weight"), 9)


def score_range(spark, sf_dir):
    return qa_processed(spark, sf_dir).agg(
        F.min("quality_score").alias("low"), F.max("quality_score").alias("high"))


def split_rows(spark, sf_dir):
    lines = given_wide(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return plan.train_test_split(lines, key=("l_orderkey", "l_linenumber"))


def split_copies(spark, sf_dir):
    """Orders share a priority: the cut falls among rows of one key, in whatever plan they come."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").repartition(7)
    return plan.train_test_split(orders, key="o_orderpriority", test_ratio=0.3)


def split_equal_rows(spark, sf_dir):
    """Rows that are equal in everything: the cut is made by count."""
    orders = given(spark, sf_dir, "orders").select("o_orderpriority").repartition(5)
    out = plan.train_test_split(orders, key="o_orderpriority", test_ratio=0.3)
    return out.groupBy("o_orderpriority", "split").agg(F.count("*").alias("n"))


def stratified_split(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("doc_id", "source")
    return plan.train_test_split(docs, key="doc_id", test_ratio=0.25, stratify_by="source")


def _rows(spark, sf_dir):
    return plan.training_rows(qa_stage(spark, sf_dir))


def chat_messages(spark, sf_dir):
    chat = plan.training_examples(_rows(spark, sf_dir), "chat")
    return chat.select(
        F.col("metadata.question_id").alias("question_id"), "split",
        F.posexplode("messages").alias("pos", "m"),
    ).select("question_id", "split", F.col("pos").cast("long").alias("pos"), "m.role",
             F.md5("m.content").alias("content_md5"))


def chat_metadata(spark, sf_dir):
    chat = plan.chat_examples(_rows(spark, sf_dir)).select("metadata.*")
    return chat.select(
        "question_id", F.concat_ws("|", "tags").alias("tags"),
        F.concat_ws("|", "error_signatures").alias("errors"),
        F.concat_ws("|", "infra_components").alias("infra"), "quality_score",
        F.round("sample_weight", 9).alias("sample_weight"))


def chat_pairs(spark, sf_dir):
    """User turns with the assistant's next turn, in the two-message form."""
    turns = given(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question_body"))
    reply = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer_body"))
    pairs = user.join(reply, ["conv_id", "turn"]).withColumn(
        "question_id", F.col("conv_id") * 1000 + F.col("turn"))
    chat = plan.chat_examples(pairs, system_prompt=None, weighted=False)
    return chat.select(
        "metadata.question_id", F.size("messages").cast("long").alias("n"),
        F.col("messages")[0]["role"].alias("first_role"), F.md5(F.col("messages")[0]["content"]).alias("user_md5"),
        F.md5(F.col("messages")[1]["content"]).alias("assistant_md5"), "metadata.quality_score")


def completions(spark, sf_dir):
    out = plan.training_examples(_rows(spark, sf_dir), "completion")
    return out.select("metadata.question_id", "split", "metadata.quality_score",
                      F.md5("prompt").alias("prompt_md5"), F.md5("completion").alias("completion_md5"))


def training_statistics(spark, sf_dir):
    rows = plan.train_test_split(_resampled(spark, sf_dir))
    return plan.training_statistics(rows)


def unmitigated_statistics(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    rows = plan.training_rows(table, _urgent(table), apply_mitigation=False, test_ratio=0.1)
    return plan.training_statistics(rows)


def train_tags(spark, sf_dir):
    return plan.train_tag_frequency(_rows(spark, sf_dir))


def summary(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    return run_summary(qa_base(spark, sf_dir), table, plan.chat_examples(table))


QUERIES = {
    "resampled_counts": resampled_counts,
    "quality_weights": weights,
    "score_range": score_range,
    "split_rows": split_rows,
    "split_among_copies": split_copies,
    "split_of_equal_rows": split_equal_rows,
    "stratified_split": stratified_split,
    "chat_messages": chat_messages,
    "chat_metadata": chat_metadata,
    "two_message_chat": chat_pairs,
    "completion_examples": completions,
    "training_statistics": training_statistics,
    "unmitigated_statistics": unmitigated_statistics,
    "train_tag_frequency": train_tags,
    "run_summary": summary,
}


# --- SQL ------------------------------------------------------------------------------

_SYSTEM = "You are an expert MLOps engineer helping to diagnose and fix infrastructure issues."
_WEIGHT = ("CASE WHEN max(quality_score) OVER () > min(quality_score) OVER () THEN 0.5 + (quality_score -"
           " min(quality_score) OVER ()) / (max(quality_score) OVER () - min(quality_score) OVER ()) ELSE 1.0 END")


def _split(table: str, key: str, train: str, partition: str = "") -> str:
    over = f"PARTITION BY {partition} " if partition else ""
    return (
        f"SELECT *, CASE WHEN row_number() OVER ({over}ORDER BY md5('42:' || {key})) <= "
        f"CAST(floor(count(*) OVER ({over}) * CAST({train} AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split"
        f" FROM {table}")


_SPLIT_QA = ("split_qa AS (SELECT *, round(" + _WEIGHT + ", 9) AS sample_weight FROM ("
             + _split("qa", "question_id || ':0'", "1 - 0.2") + "))")

# Scalar slices come first and take up places; then array slices by value. Large ones are left out.
_RESAMPLED = f"""
mem AS (SELECT dimension, value, count(*) AS n FROM (
  SELECT 'question_type' AS dimension, question_type AS value, 1 AS ord FROM qa
  UNION ALL SELECT 'infra_components', unnest(list_distinct(infra_components)), 5 FROM qa)
  GROUP BY dimension, value),
urgent AS (SELECT *, row_number() OVER (ORDER BY CASE dimension WHEN 'question_type' THEN 1 ELSE 5 END, value) AS r
  FROM mem WHERE n / (SELECT count(*) FROM qa) < 0.2 AND n < 10000000),
chosen AS (SELECT *, row_number() OVER (ORDER BY value) AS place FROM urgent
  WHERE r <= 30 AND dimension = 'infra_components'),
member AS (SELECT place, n, question_id, row_number() OVER (PARTITION BY place
    ORDER BY md5('42:' || question_id), question_id) AS idx
  FROM (SELECT question_id, unnest(list_distinct(infra_components)) AS value FROM qa) JOIN chosen USING (value)
  WHERE n < 5000),
draws AS (SELECT place, n, unnest(range(1, least(n * 2, 100) + 1)) AS draw FROM chosen WHERE n < 5000),
drawn AS (SELECT d.place, d.draw, question_id FROM (
    SELECT *, CAST('0x' || substr(md5('42:' || place || ':' || draw), 1, 8) AS BIGINT) % n + 1 AS idx FROM draws) d
  JOIN member m ON d.place = m.place AND d.idx = m.idx),
resampled AS (SELECT question_id, CAST(0 AS BIGINT) AS copy FROM qa
  UNION ALL SELECT question_id, (place - 1) * 100 + draw FROM drawn)"""

_STATISTICS = """SELECT count(*) FILTER (WHERE copy = 0) AS input_records, count(*) AS after_resampling,
  count(*) FILTER (WHERE split = 'train') AS train_examples,
  count(*) FILTER (WHERE split = 'test') AS test_examples, count(*) AS total_examples"""

ORACLE = {
    "resampled_counts": W.with_qa("""
SELECT copy, count(*) AS n, CAST(sum(CASE WHEN copy > 0 THEN question_id ELSE 0 END) AS BIGINT) AS drawn_id
FROM resampled GROUP BY copy""", _RESAMPLED),
    "quality_weights": W.with_qa(f"SELECT question_id, round({_WEIGHT}, 9) AS sample_weight FROM qa"),
    "score_range": W.with_qa("SELECT min(quality_score) AS low, max(quality_score) AS high FROM qa"),
    "split_rows": _split("(SELECT l_orderkey, l_linenumber FROM lineitem)", "l_orderkey || ':' || l_linenumber",
                         "1 - 0.2"),
    "split_among_copies": _split(
        "(SELECT o_orderkey, o_orderpriority FROM orders)",
        "o_orderpriority || '') || md5('{\"o_orderkey\":' || o_orderkey || ',\"o_orderpriority\":\"' || o_orderpriority || '\"}'",
        "1 - 0.3"),
    "split_of_equal_rows": "SELECT o_orderpriority, split, count(*) AS n FROM (" + _split(
        "(SELECT o_orderpriority FROM orders)", "o_orderpriority", "1 - 0.3") + ") GROUP BY ALL",
    "stratified_split": _split("(SELECT doc_id, source FROM documents)", "doc_id", "1 - 0.25", "source"),
    "chat_messages": W.with_qa(f"""
SELECT question_id, split, CAST(0 AS BIGINT) AS pos, 'system' AS role, md5('{_SYSTEM}') AS content_md5 FROM split_qa
UNION ALL SELECT question_id, split, 1, 'user', md5(question_body) FROM split_qa
UNION ALL SELECT question_id, split, 2, 'assistant', md5(answer_body) FROM split_qa""", _SPLIT_QA),
    "chat_metadata": W.with_qa("""
SELECT question_id, array_to_string(tags, '|') AS tags, array_to_string(error_signatures, '|') AS errors,
       array_to_string(infra_components, '|') AS infra, quality_score, sample_weight FROM split_qa""", _SPLIT_QA),
    "two_message_chat": """
SELECT u.conv_id * 1000 + a.turn AS question_id, CAST(2 AS BIGINT) AS n, 'user' AS first_role,
       md5(u.text) AS user_md5, md5(a.text) AS assistant_md5, CAST(0 AS DOUBLE) AS quality_score
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""",
    "completion_examples": W.with_qa("""
SELECT question_id, split, quality_score,
       md5('### Question' || chr(10) || title || chr(10) || chr(10) || question_body || chr(10) || chr(10)
           || 'Tags: ' || array_to_string(tags, ', ') || chr(10) || chr(10) || '### Answer' || chr(10)) AS prompt_md5,
       md5(answer_body) AS completion_md5 FROM split_qa""", _SPLIT_QA),
    "training_statistics": W.with_qa(
        _STATISTICS + " FROM s", _RESAMPLED,
        "s AS (" + _split("resampled", "question_id || ':' || copy", "1 - 0.2") + ")"),
    "unmitigated_statistics": W.with_qa(
        _STATISTICS + " FROM (SELECT *, CAST(0 AS BIGINT) AS copy FROM s)",
        "s AS (" + _split("qa", "question_id || ':0'", "1 - 0.1") + ")"),
    "train_tag_frequency": W.with_qa("""
SELECT value, count(*) AS n FROM (SELECT unnest(tags) AS value FROM split_qa WHERE split = 'train')
GROUP BY value ORDER BY n DESC, value LIMIT 10""", _SPLIT_QA),
    "run_summary": W.with_qa("""
SELECT (SELECT count(*) FROM documents) AS records_acquired, (SELECT count(*) FROM qa) AS records_processed,
       (SELECT count(*) FROM qa) AS training_examples"""),
}

COVERS = {
    "resampled_counts": ("T1", "J6", "O3", "U1"),
    "quality_weights": ("T2", "F12", "A28"),
    "score_range": ("A28",),
    "split_rows": ("T4", "W5"),
    "split_among_copies": ("T4", "W5"),
    "split_of_equal_rows": ("T4", "W5"),
    "stratified_split": ("T4", "W5"),
    "chat_messages": ("T3", "T6"),
    "chat_metadata": ("T3",),
    "two_message_chat": ("T3",),
    "completion_examples": ("T5", "T6", "F14"),
    "training_statistics": ("A32", "T6"),
    "unmitigated_statistics": ("A32", "T6"),
    "train_tag_frequency": ("A27",),
    "run_summary": ("A31",),
}
