"""Slices, their metrics, bias verdicts and suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalathe.plans import bias as plan

from . import working as W
from .validate import _rounded
from .working import given, qa_processed, qa_stage

# The smallest threshold at which the given data shows all kinds of factors.
_LIMIT = 0.05


def _documents(spark, sf_dir):
    """All documents, labelled ones with their label, as rows with the slice columns."""
    docs = given(spark, sf_dir, "documents")
    labels = given(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("question_id"), F.col("lang").alias("question_type"),
        F.col("quality").cast("string").alias("complexity"), F.array("source", "source").alias("tags"),
        (F.col("n_chars") % 977).cast("double").alias("quality_score"),
        (F.col("doc_id") % 89).alias("answer_score"),
        F.col("text").alias("question_body"), F.col("text").alias("answer_body"))


def column_slices(spark, sf_dir):
    return plan.slices_of(qa_processed(spark, sf_dir), "question_type")


def tag_slices(spark, sf_dir):
    return plan.slices_of(qa_processed(spark, sf_dir), "tags")


def error_slices(spark, sf_dir):
    return plan.slices_of(qa_processed(spark, sf_dir), "error_signatures", 60)


def infra_slices(spark, sf_dir):
    return plan.slices_of(qa_processed(spark, sf_dir), "infra_components", 1)


def label_slices(spark, sf_dir):
    return plan.slices_of(_documents(spark, sf_dir), "complexity", 0)


def membership_rows(spark, sf_dir):
    return plan.memberships(qa_processed(spark, sf_dir), keep=("question_id",))


def slice_metrics(spark, sf_dir):
    return _rounded(plan.slice_metrics(qa_stage(spark, sf_dir)))


def document_slice_metrics(spark, sf_dir):
    return _rounded(plan.slice_metrics(_documents(spark, sf_dir), min_samples=1))


def overall(spark, sf_dir):
    return _rounded(plan.overall_metrics(qa_stage(spark, sf_dir)))


def complexity_shares(spark, sf_dir):
    return _rounded(plan.slice_shares(qa_stage(spark, sf_dir)))


def _verdicts(spark, sf_dir, min_samples=None, threshold=None, **limits):
    table = qa_stage(spark, sf_dir)
    return plan.bias_verdicts(
        plan.slice_metrics(table, min_samples, median=False), plan.overall_metrics(table, median=False),
        threshold, **limits)


def verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select("slice", "dimension", "value", "count", "is_biased", "severity",
                                           F.size("bias_factors").cast("long").alias("n_factors"))


def verdict_factors(spark, sf_dir):
    out = _verdicts(spark, sf_dir, 1, _LIMIT, length_threshold=0.1, min_proportion=0.06, min_count=10_000)
    return out.select("slice", "severity", F.explode("bias_factors").alias("f")).select(
        "slice", "severity", "f.*").withColumn("slice_count", F.col("slice_count").cast("double"))


def biased(spark, sf_dir):
    out = _verdicts(spark, sf_dir, 1, _LIMIT)
    return plan.biased_slices(out).select("slice", "severity")


def summary(spark, sf_dir):
    return _rounded(plan.bias_summary(_verdicts(spark, sf_dir, 1, _LIMIT, length_threshold=0.1)))


def suggestion_rows(spark, sf_dir):
    out = _verdicts(spark, sf_dir, 1, _LIMIT, length_threshold=0.1, min_proportion=0.06, min_count=10_000)
    return plan.suggestions(out).withColumn("factor_order", F.col("factor_order").cast("long"))


def bias_run_metrics(spark, sf_dir):
    return _rounded(plan.bias_run_metrics(_verdicts(spark, sf_dir, 1, _LIMIT)))


QUERIES = {
    "column_slices": column_slices,
    "tag_slices": tag_slices,
    "error_slices": error_slices,
    "infra_slices": infra_slices,
    "label_slices": label_slices,
    "slice_memberships": membership_rows,
    "slice_metrics": slice_metrics,
    "document_slice_metrics": document_slice_metrics,
    "overall_metrics": overall,
    "complexity_shares": complexity_shares,
    "bias_verdicts": verdicts,
    "bias_factors": verdict_factors,
    "biased_slices": biased,
    "bias_summary": summary,
    "mitigation_suggestions": suggestion_rows,
    "bias_run_metrics": bias_run_metrics,
}


# --- SQL ------------------------------------------------------------------------------

def _members(table: str, scalars, arrays) -> str:
    measures = "quality_score, answer_score, length(question_body) AS ql, length(answer_body) AS al"
    parts = [
        f"SELECT question_id, {measures}, complexity AS cls, '{c}' AS dimension, {c} AS value, {c} AS slice FROM {table}"
        for c in scalars
    ] + [
        f"SELECT question_id, quality_score, answer_score, ql, al, cls, '{c}' AS dimension, value, '{p}' || value AS slice"
        f" FROM (SELECT question_id, {measures}, complexity AS cls, unnest(list_distinct({c})) AS value FROM {table})"
        for c, p in arrays
    ]
    return "mem AS (SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE value IS NOT NULL)"


_ARRAYS = (("tags", "tag_"), ("error_signatures", "error_"), ("infra_components", "infra_"))
_SCALARS = ("question_type", "complexity")
_MEM = _members("qa", _SCALARS, _ARRAYS)
_DOCS = """docs AS (SELECT documents.doc_id AS question_id, lang AS question_type,
  CAST(quality AS VARCHAR) AS complexity, [source, source] AS tags,
  CAST(n_chars % 977 AS DOUBLE) AS quality_score, documents.doc_id % 89 AS answer_score,
  text AS question_body, text AS answer_body
  FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)"""


def _means(digits: int | None = 6) -> str:
    def r(x):
        return f"round({x}, {digits})" if digits else x

    return ", ".join(
        f"{r(f'avg({c})')} AS {n}_mean, {r(f'stddev_samp({c})')} AS {n}_std"
        for c, n in (("quality_score", "quality_score"), ("answer_score", "answer_score"),
                     ("ql", "question_length"), ("al", "answer_length")))


def _metrics(table: str, least: int) -> str:
    return f"""SELECT dimension, value, count(*) AS "count", {_means()},
  round(count(*) / (SELECT count(*) FROM {table}), 6) AS proportion, any_value(slice) AS slice,
  round(quantile_cont(quality_score, 0.5), 6) AS quality_score_median
FROM mem GROUP BY dimension, value HAVING count(*) >= {least}"""


def _exact(c: str) -> str:
    """The mean from an exact sum, so that it does not hang on the order of the rows."""
    return f"CAST(sum(CAST(round({c} * 1000000) AS HUGEINT)) AS DOUBLE) / CAST(1000000 AS DOUBLE) / count({c})"


def _judged(least=30, limit=0.25, length=0.5, proportion=0.005, count=20) -> str:
    def factor(i, x, o, lim, up, down, name):
        ratio = f"abs({x} - {o}) / {o}"
        return f"""CASE WHEN {o} > 0 AND {ratio} > {lim} THEN 1 ELSE 0 END AS f{i},
  {W.rounded(x, 2)} AS value{i}, {W.rounded(o, 2)} AS overall{i}, {W.rounded(ratio, 3)} AS ratio{i},
  CASE WHEN {x} > {o} THEN '{up}' ELSE '{down}' END AS direction{i}, '{name}' AS name{i}"""

    return f"""raw AS (SELECT dimension, value, any_value(slice) AS slice, count(*) AS n,
   {_exact('quality_score')} AS q, CAST(avg(al) AS DOUBLE) AS l, count(*) / (SELECT count(*) FROM qa) AS p
   FROM mem GROUP BY dimension, value HAVING count(*) >= {least}),
o AS (SELECT {_exact('quality_score')} AS oq, CAST(avg(length(answer_body)) AS DOUBLE) AS ol FROM qa),
factored AS (SELECT *, {factor(1, 'q', 'oq', limit, 'higher', 'lower', 'quality_score')},
   {factor(2, 'l', 'ol', length, 'longer', 'shorter', 'answer_length')},
   CASE WHEN p < {proportion} AND n < {count} THEN 1 ELSE 0 END AS f3 FROM raw, o),
judged AS (SELECT *, f1 + f2 + f3 AS nf, greatest(f1 * ratio1, f2 * ratio2) AS worst,
   CASE WHEN f1 + f2 + f3 = 0 THEN 'none'
        WHEN greatest(f1 * ratio1, f2 * ratio2) > 0.75 OR f1 + f2 + f3 >= 3 THEN 'high'
        WHEN greatest(f1 * ratio1, f2 * ratio2) > 0.5 OR f1 + f2 + f3 >= 2 THEN 'medium'
        ELSE 'low' END AS severity FROM factored)"""


def _slices(column: str, least: int, array: bool, table: str = "qa") -> str:
    rows = f"SELECT unnest(list_distinct({column})) AS value FROM {table}" if array else (
        f"SELECT {column} AS value FROM {table}")
    return f"""SELECT '{column}' AS dimension, value, count(*) AS "count" FROM ({rows})
WHERE value IS NOT NULL GROUP BY value HAVING count(*) >= {least}"""


_WIDE = dict(least=1, limit=_LIMIT, length=0.1, proportion=0.06, count=10_000)
_SUGGESTED = f"""suggested AS (
SELECT slice, dimension, value, n AS "count", CAST(0 AS BIGINT) AS factor_order,
  'Lower quality examples' AS issue, 'quality_filtering' AS strategy,
  'Slice ''' || slice || ''' has lower quality scores. Consider: (1) Setting higher quality thresholds for this slice, (2) Manual review and curation, (3) Weighted sampling during training' AS description,
  'medium' AS priority FROM judged WHERE f1 = 1 AND direction1 = 'lower'
UNION ALL SELECT slice, dimension, value, n, f1, 'Answers are ' || direction2 || ' than average', 'length_normalization',
  'Consider normalizing answer lengths or using length-aware training strategies', 'low' FROM judged WHERE f2 = 1
UNION ALL SELECT slice, dimension, value, n, f1 + f2, 'Underrepresentation', 'data_augmentation',
  'Consider augmenting data for ''' || slice || ''' through: (1) Collecting more examples, (2) Synthetic data generation, (3) Oversampling existing examples',
  CASE WHEN n < 50 THEN 'high' ELSE 'medium' END FROM judged WHERE f3 = 1)"""
_SUMMARY = """SELECT count(*) AS total_slices, count(*) FILTER (WHERE nf > 0) AS biased_slices,
  round(avg(CASE WHEN nf > 0 THEN 1.0 ELSE 0.0 END), 6) AS bias_rate,
  count(*) FILTER (WHERE severity = 'high') AS high_severity_count,
  count(*) FILTER (WHERE severity = 'medium') AS medium_severity_count,
  count(*) FILTER (WHERE severity = 'low') AS low_severity_count"""

ORACLE = {
    "column_slices": W.with_qa(_slices("question_type", 30, False)),
    "tag_slices": W.with_qa(_slices("tags", 30, True)),
    "error_slices": W.with_qa(_slices("error_signatures", 60, True)),
    "infra_slices": W.with_qa(_slices("infra_components", 1, True)),
    "label_slices": f"WITH {_DOCS} " + _slices("complexity", 0, False, "docs"),
    "slice_memberships": W.with_qa("SELECT question_id, dimension, value FROM mem", _MEM),
    "slice_metrics": W.with_qa(_metrics("qa", 30), _MEM),
    "document_slice_metrics":
        f"WITH {_DOCS}, {_members('docs', _SCALARS, _ARRAYS[:1])} " + _metrics("docs", 1),
    "overall_metrics": W.with_qa(f"""
SELECT count(*) AS "count", {_means()}, CAST(1 AS DOUBLE) AS proportion,
  round(quantile_cont(quality_score, 0.5), 6) AS quality_score_median
FROM (SELECT *, length(question_body) AS ql, length(answer_body) AS al FROM qa)"""),
    "complexity_shares": W.with_qa("""
SELECT dimension, value, cls AS class, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY dimension, value), 6) AS share
FROM mem WHERE (dimension, value) IN
  (SELECT (dimension, value) FROM mem GROUP BY dimension, value HAVING count(*) >= 30)
GROUP BY dimension, value, cls""", _MEM),
    "bias_verdicts": W.with_qa("""
SELECT slice, dimension, value, n AS "count", nf > 0 AS is_biased, severity, CAST(nf AS BIGINT) AS n_factors
FROM judged""", _MEM, _judged()),
    "bias_factors": W.with_qa("""
SELECT slice, severity, name1 AS factor, value1 AS slice_value, overall1 AS overall_value,
  ratio1 AS difference_ratio, direction1 AS direction, CAST(NULL AS DOUBLE) AS slice_proportion,
  CAST(NULL AS DOUBLE) AS slice_count, CAST(NULL AS VARCHAR) AS message FROM judged WHERE f1 = 1
UNION ALL SELECT slice, severity, name2, value2, overall2, ratio2, direction2, NULL, NULL, NULL
FROM judged WHERE f2 = 1
UNION ALL SELECT slice, severity, 'underrepresentation', NULL, NULL, NULL, NULL, """ + W.rounded("p", 4)
                              + """, CAST(n AS DOUBLE), 'Slice severely underrepresented' FROM judged WHERE f3 = 1""",
                              _MEM, _judged(**_WIDE)),
    "biased_slices": W.with_qa("SELECT slice, severity FROM judged WHERE nf > 0", _MEM,
                               _judged(least=1, limit=_LIMIT)),
    "bias_summary": W.with_qa(_SUMMARY + " FROM judged", _MEM, _judged(least=1, limit=_LIMIT, length=0.1)),
    "mitigation_suggestions": W.with_qa("SELECT * FROM suggested", _MEM, _judged(**_WIDE), _SUGGESTED),
    "bias_run_metrics": W.with_qa(
        _SUMMARY + ", (SELECT count(*) FROM suggested) AS mitigation_suggestions_count FROM judged",
        _MEM, _judged(least=1, limit=_LIMIT), _SUGGESTED),
}

COVERS = {
    "column_slices": ("B1", "A23"),
    "tag_slices": ("B2", "A23", "J3", "U3"),
    "error_slices": ("B3", "A23", "J3", "U3"),
    "infra_slices": ("B4", "A23", "J3", "U3"),
    "label_slices": ("B1",),
    "slice_memberships": ("A22", "U2", "U3"),
    "slice_metrics": ("A20", "A22", "A23"),
    "document_slice_metrics": ("A20", "A22"),
    "overall_metrics": ("A20",),
    "complexity_shares": ("A21",),
    "bias_verdicts": ("J4", "B5", "B6", "B7", "B8", "B9", "F13"),
    "bias_factors": ("J4", "B5", "B6", "B7", "B8", "F13"),
    "biased_slices": ("B9",),
    "bias_summary": ("A26",),
    "mitigation_suggestions": ("B10",),
    "bias_run_metrics": ("A30",),
}
