"""Checks, outliers, statistics and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalathe import functions as fx
from qalathe.plans import validate as plan
from qalathe.plans.checks import verdict

from . import working as W
from .working import given, given_wide, qa_base, qa_processed, qa_stage

_NUMBERS = ("score", "answer_score", "view_count", "quality_score")


def _rounded(df, digits=6):
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _checks(df):
    return _rounded(df).withColumn("ordinal", F.col("ordinal").cast("long"))


def _turns_as_questions(spark, sf_dir):
    """Chat turns under a repeated key: duplicates, and most expected columns absent."""
    return given(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("question_id"), F.col("text").alias("question_body"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("answer_body"), "turn")


def validation_checks(spark, sf_dir):
    return _checks(plan.validation_checks(qa_stage(spark, sf_dir)))


def failing_checks(spark, sf_dir):
    return _checks(plan.validation_checks(_turns_as_questions(spark, sf_dir)))


def quality_checks(spark, sf_dir):
    return _checks(plan.quality_checks(qa_base(spark, sf_dir)))


def text_checks(spark, sf_dir):
    return _checks(plan.text_checks(qa_base(spark, sf_dir)))


def distribution_checks(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select(
        F.col("n_chars").alias("score"), F.array("lang").alias("tags"))
    return _checks(plan.distribution_checks(docs, min_tags=5))


def anomaly_checks(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select(
        "n_chars", F.concat("text", F.lit(" <br>")).alias("question_body"))
    return _checks(plan.anomaly_checks(docs, columns=("n_chars",)))


def key_duplicates(spark, sf_dir):
    from qalathe.operators import duplicate_summary

    return duplicate_summary(given(spark, sf_dir, "lineitem"), "l_orderkey")


def keep_first_flags(spark, sf_dir):
    from qalathe.operators import duplicate_flags

    turns = given(spark, sf_dir, "conversations")
    return duplicate_flags(turns, "conv_id", "turn").select("conv_id", "turn", "is_duplicate")


def text_lengths(spark, sf_dir):
    return _rounded(plan.describe_texts(qa_stage(spark, sf_dir), median=True))


def score_description(spark, sf_dir):
    return _rounded(plan.describe_numbers(
        qa_stage(spark, sf_dir).select(*_NUMBERS), ("score", "quality_score")))


def numeric_description(spark, sf_dir):
    return _rounded(plan.describe_numbers(given_wide(spark, sf_dir, "lineitem")), 4)


def categories(spark, sf_dir):
    return plan.category_counts(qa_processed(spark, sf_dir))


def order_categories(spark, sf_dir):
    return plan.category_counts(given(spark, sf_dir, "orders"), ("o_orderstatus", "o_orderpriority"))


def top_tags(spark, sf_dir):
    return plan.top_tags(qa_processed(spark, sf_dir), 20)


def error_frequency(spark, sf_dir):
    from qalathe.operators import value_counts

    return value_counts(qa_processed(spark, sf_dir), "error_signatures")


def distinct_tags(spark, sf_dir):
    from qalathe.operators import value_counts

    return value_counts(qa_processed(spark, sf_dir), "tags").agg(F.count("*").alias("distinct_tags"))


def price_bounds(spark, sf_dir):
    lines = given_wide(spark, sf_dir, "lineitem", "l_extendedprice", "l_quantity").withColumn(
        "unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return _rounded(plan.iqr_bounds(lines, ("l_extendedprice", "l_quantity", "unit_price")))


def price_outliers(spark, sf_dir):
    lines = given_wide(spark, sf_dir, "lineitem", "l_extendedprice", "l_quantity").withColumn(
        "unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return plan.outlier_counts(lines, ("l_extendedprice", "unit_price"))


def anomaly_rows(spark, sf_dir):
    return _rounded(plan.anomalies(qa_stage(spark, sf_dir), factor=0.5))


def event_anomalies(spark, sf_dir):
    return _rounded(plan.anomalies(given(spark, sf_dir, "events"), ("value",), key="event_id"))


def leftover_html(spark, sf_dir):
    pages = given(spark, sf_dir, "pages")
    return pages.agg(
        F.count_if(fx.has_leftover_tags("html")).alias("raw_pages"),
        F.count_if(fx.has_leftover_tags(fx.clean_html("html"))).alias("cleaned_pages"))


def check_verdict(spark, sf_dir):
    return verdict(plan.validation_checks(_turns_as_questions(spark, sf_dir)))


def run_metrics(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    return plan.validation_metrics(table, plan.validation_checks(table))


def gate_open(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    return plan.gated(table, plan.quality_checks(table)).select("question_id", "quality_score")


def gate_closed(spark, sf_dir):
    table = _turns_as_questions(spark, sf_dir)
    return plan.gated(table, plan.quality_checks(table)).select("question_id", "turn")


QUERIES = {
    "validation_checks": validation_checks,
    "failing_checks": failing_checks,
    "quality_checks": quality_checks,
    "text_checks": text_checks,
    "distribution_checks": distribution_checks,
    "anomaly_checks": anomaly_checks,
    "key_duplicates": key_duplicates,
    "keep_first_flags": keep_first_flags,
    "text_lengths": text_lengths,
    "score_description": score_description,
    "numeric_description": numeric_description,
    "category_counts": categories,
    "order_category_counts": order_categories,
    "top_tags": top_tags,
    "error_frequency": error_frequency,
    "distinct_tags": distinct_tags,
    "price_bounds": price_bounds,
    "price_outlier_counts": price_outliers,
    "anomaly_rows": anomaly_rows,
    "event_anomalies": event_anomalies,
    "leftover_html": leftover_html,
    "check_verdict": check_verdict,
    "validation_run_metrics": run_metrics,
    "gate_open": gate_open,
    "gate_closed": gate_closed,
}


# --- SQL ------------------------------------------------------------------------------

def _row(ordinal, check, column, status, value, threshold, message, table="m") -> str:
    column = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT CAST({ordinal} AS BIGINT) AS ordinal, '{check}' AS \"check\","
        f" CAST({column} AS VARCHAR) AS \"column\", {status} AS status,"
        f" round(CAST({value} AS DOUBLE), 6) AS value, CAST({threshold} AS DOUBLE) AS threshold,"
        f" {message} AS message FROM {table}"
    )


def _table(*rows) -> str:
    body = "\nUNION ALL ".join(rows)
    return (
        "SELECT ordinal, \"check\", \"column\", status,"
        " CASE status WHEN 'fail' THEN 'error' WHEN 'warn' THEN 'warning' ELSE 'info' END AS severity,"
        f" value, threshold, message FROM ({body}) AS r WHERE status IS NOT NULL"
    )


def _pct(x: str) -> str:
    return f"printf('%.1f%%', {x} * 100)"


def _quality_rows(nulls, texts, key="question_id") -> list[str]:
    rows = [_row(
        200, "min_rows", None, "CASE WHEN n >= 100 THEN 'pass' ELSE 'fail' END", "n", 100,
        "CASE WHEN n >= 100 THEN 'Row count (' || n || ') meets minimum (100)'"
        " ELSE 'Only ' || n || ' rows, minimum required: 100' END")]
    for i, c in nulls:
        x = f"null_{c}"
        rows.append(_row(
            210 + i, "missing_values", c,
            f"CASE WHEN {x} / n > 0.1 THEN 'fail' WHEN {x} > 0 THEN 'warn' ELSE 'pass' END",
            f"{x} / n", 0.1,
            f"CASE WHEN {x} / n > 0.1 THEN 'Column ''{c}'' has ' || {_pct(f'{x} / n')} || ' missing values'"
            f" WHEN {x} > 0 THEN 'Column ''{c}'' has ' || {x} || ' missing values (' || {_pct(f'{x} / n')} || ')'"
            f" ELSE 'Column ''{c}'' has no missing values' END"))
    rows.append(_row(
        220, "duplicates", key,
        "CASE WHEN copies / n > 0.05 THEN 'fail' WHEN copies > 0 THEN 'warn' ELSE 'pass' END",
        "copies / n", 0.05,
        f"CASE WHEN copies / n > 0.05 THEN 'Found ' || copies || ' duplicate {key}s (' || {_pct('copies / n')} || ')'"
        f" WHEN copies > 0 THEN 'Found ' || copies || ' duplicates' ELSE 'No duplicate {key}s found' END"))
    for i, c in texts:
        rows.append(_row(230 + i, "empty_strings", c, f"CASE WHEN blank_{c} > 0 THEN 'warn' END",
                         f"blank_{c}", 0, f"'Column ''{c}'' has ' || blank_{c} || ' empty strings'"))
    return rows


def _text_rows() -> list[str]:
    return [
        _row(300, "text_quality", "question_body",
             "CASE WHEN short_q > n * CAST(0.1 AS DOUBLE) THEN 'warn' ELSE 'pass' END", "short_q", 0.1,
             "CASE WHEN short_q > n * CAST(0.1 AS DOUBLE) THEN short_q || ' questions are very short (<50 chars)'"
             " ELSE 'Question lengths are acceptable' END"),
        _row(301, "text_quality", "answer_body",
             "CASE WHEN short_a > n * CAST(0.1 AS DOUBLE) THEN 'warn' END", "short_a", 0.1,
             "short_a || ' answers are very short (<100 chars)'"),
    ]


def _anomaly_rows(columns) -> list[str]:
    return [
        _row(500 + i, "anomaly_detection", c,
             f"CASE WHEN out_{c} > n * CAST(0.05 AS DOUBLE) THEN 'warn' END", f"out_{c}", 0.05,
             f"'Found ' || out_{c} || ' outliers in ''{c}'''")
        for i, c in enumerate(columns)
    ] + [_row(520, "anomaly_detection", "question_body", "CASE WHEN html > 0 THEN 'warn' END", "html", 0,
              "'Found ' || html || ' records with uncleaned HTML'")]


def _bounds(table: str, columns, factor="1.5") -> str:
    parts = ", ".join(
        f"quantile_cont({c}, 0.25) - {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c},"
        f" quantile_cont({c}, 0.75) + {factor} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}"
        for c in columns)
    return f"SELECT {parts} FROM {table}"


def _outliers(table: str, columns, bounds: str = "b") -> str:
    parts = ", ".join(
        f"count(*) FILTER (WHERE {c} < lo_{c} OR {c} > hi_{c}) AS out_{c}" for c in columns)
    return f"SELECT {parts} FROM {table}, {bounds}"


_COMMON = """count(*) AS n, count(*) FILTER (WHERE question_id IS NULL) AS null_question_id,
 count(*) FILTER (WHERE question_body IS NULL) AS null_question_body,
 count(*) FILTER (WHERE answer_body IS NULL) AS null_answer_body,
 count(*) - count(DISTINCT question_id) AS copies,
 count(*) FILTER (WHERE regexp_full_match(question_body, '\\s*')) AS blank_question_body,
 count(*) FILTER (WHERE regexp_full_match(answer_body, '\\s*')) AS blank_answer_body,
 count(*) FILTER (WHERE length(question_body) < 50) AS short_q,
 count(*) FILTER (WHERE length(answer_body) < 100) AS short_a,
 count(*) FILTER (WHERE regexp_matches(coalesce(question_body, ''), '<[a-z]+>')) AS html"""
_NULLS = list(enumerate(("question_id", "question_body", "answer_body")))
_TEXTS = list(enumerate(("question_body", "answer_body")))
_BLANK_TITLE = "count(*) FILTER (WHERE regexp_full_match(title, '\\s*')) AS blank_title"

_QA_CHECKS = W.with_qa(
    _table(
        _row(100, "schema_required_columns", None, "'pass'", "0", 0, "'All required columns present'"),
        *_quality_rows(_NULLS, [*_TEXTS, (2, "title")]), *_text_rows(),
        _row(400, "feature_distribution", "score", "CASE WHEN sd = 0 THEN 'warn' END", "sd", 0,
             "'All scores are identical'"),
        _row(401, "feature_distribution", "tags", "CASE WHEN tag_n < 3 THEN 'warn' END", "tag_n", 3,
             "'Very few unique tags found'"),
        *_anomaly_rows(_NUMBERS)),
    f"b AS ({_bounds('qa', _NUMBERS)})",
    f"m AS (SELECT * FROM (SELECT {_COMMON}, {_BLANK_TITLE}, stddev_samp(score) AS sd FROM qa),"
    f" ({_outliers('qa', _NUMBERS)}),"
    " (SELECT count(DISTINCT t) AS tag_n FROM (SELECT unnest(tags) AS t FROM qa)))",
)
_TURNS = """turns AS (SELECT conv_id AS question_id, text AS question_body,
 CASE WHEN role = 'assistant' THEN text END AS answer_body, turn FROM conversations)"""
_TURN_CHECKS = f"""
WITH {_TURNS}, m AS (SELECT {_COMMON} FROM turns)
""" + _table(
    _row(100, "schema_required_columns", None, "'fail'", "4", 0,
         "'Missing required columns: {''quality_score'', ''score'', ''tags'', ''title''}'"),
    _row(101, "schema_extra_columns", None, "'warn'", "1", 0, "'Unexpected columns found: {''turn''}'"),
    *_quality_rows(_NULLS, _TEXTS), *_text_rows(), *_anomaly_rows(()))


def _describe(table: str, columns, digits=6) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), {digits}) AS mean,"
        f" round(stddev_samp(CAST({c} AS DOUBLE)), {digits}) AS std, round(CAST(min({c}) AS DOUBLE), {digits}) AS min,"
        + "".join(f" round(quantile_cont(CAST({c} AS DOUBLE), {p}), {digits}) AS {q},"
                  for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
        + f" round(CAST(max({c}) AS DOUBLE), {digits}) AS max FROM {table}"
        for c in columns)


def _anomaly_list(table: str, columns, key: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT 'outlier' AS \"type\", '{c}' AS \"column\", {key}, round(CAST({c} AS DOUBLE), 6) AS value,"
        f" round(lo_{c}, 6) AS lower_bound, round(hi_{c}, 6) AS upper_bound"
        f" FROM {table}, b WHERE {c} < lo_{c} OR {c} > hi_{c}" for c in columns)


def _bound_rows(table: str, columns) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(q25, 6) AS q25, round(q75, 6) AS q75,"
        f" round(q25 - 1.5 * (q75 - q25), 6) AS lower_bound, round(q75 + 1.5 * (q75 - q25), 6) AS upper_bound"
        f" FROM (SELECT quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.75) AS q75 FROM {table})"
        for c in columns)


_LINES = "lines AS (SELECT *, l_extendedprice / l_quantity AS unit_price FROM lineitem)"
_VERDICT = """SELECT count(*) FILTER (WHERE status = 'fail' AND severity = 'error') = 0 AS is_valid,
 count(*) FILTER (WHERE status IN ('pass', 'fail')) AS total_checks,
 count(*) FILTER (WHERE status = 'pass') AS passed_count,
 count(*) FILTER (WHERE status = 'fail') AS failed_count,
 count(*) FILTER (WHERE status = 'warn') AS warning_count"""

ORACLE = {
    "validation_checks": _QA_CHECKS,
    "failing_checks": _TURN_CHECKS,
    "quality_checks": f"""
WITH qa_base AS ({W.QA_BASE_SQL}), m AS (SELECT {_COMMON}, {_BLANK_TITLE} FROM qa_base)
""" + _table(*_quality_rows(_NULLS, [*_TEXTS, (2, "title")])),
    "text_checks": f"""
WITH qa_base AS ({W.QA_BASE_SQL}), m AS (SELECT {_COMMON} FROM qa_base)
""" + _table(*_text_rows()),
    "distribution_checks": "WITH m AS (SELECT count(DISTINCT lang) AS tag_n, stddev_samp(n_chars) AS sd"
                           " FROM documents) " + _table(
        _row(400, "feature_distribution", "score", "CASE WHEN sd = 0 THEN 'warn' END", "sd", 0,
             "'All scores are identical'"),
        _row(401, "feature_distribution", "tags", "CASE WHEN tag_n < 5 THEN 'warn' END", "tag_n", 5,
             "'Very few unique tags found'")),
    "anomaly_checks": f"""
WITH b AS ({_bounds('documents', ('n_chars',))}),
m AS (SELECT * FROM (SELECT count(*) AS n, count(*) AS html FROM documents),
      ({_outliers('documents', ('n_chars',))}))
""" + _table(*_anomaly_rows(("n_chars",))),
    "key_duplicates": """
SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_keys,
       count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem""",
    "keep_first_flags": """
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 AS is_duplicate
FROM conversations""",
    "text_lengths": W.with_qa("\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(length({c})), 6) AS avg_length,"
        f" CAST(min(length({c})) AS BIGINT) AS min_length, CAST(max(length({c})) AS BIGINT) AS max_length,"
        f" CAST(sum(length({c})) AS BIGINT) AS total_chars,"
        f" round(quantile_cont(CAST(length({c}) AS DOUBLE), 0.5), 6) AS median_length FROM qa"
        for c in ("title", "question_body", "answer_body"))),
    "score_description": W.with_qa(_describe("qa", ("score", "quality_score"))),
    "numeric_description": _describe("lineitem", (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax"), 4),
    "category_counts": W.with_qa("""
SELECT 'question_type' AS "column", question_type AS value, count(*) AS n FROM qa GROUP BY question_type
UNION ALL SELECT 'complexity', complexity, count(*) FROM qa GROUP BY complexity"""),
    "order_category_counts": """
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL""",
    "top_tags": W.with_qa("""
SELECT value, count(*) AS n FROM (SELECT unnest(tags) AS value FROM qa)
GROUP BY value ORDER BY n DESC, value LIMIT 20"""),
    "error_frequency": W.with_qa("""
SELECT value, count(*) AS n FROM (SELECT unnest(error_signatures) AS value FROM qa) GROUP BY value"""),
    "distinct_tags": W.with_qa(
        "SELECT count(DISTINCT t) AS distinct_tags FROM (SELECT unnest(tags) AS t FROM qa)"),
    "price_bounds": f"WITH {_LINES} " + _bound_rows("lines", ("l_extendedprice", "l_quantity", "unit_price")),
    "price_outlier_counts": f"""
WITH {_LINES}, b AS ({_bounds('lines', ('l_extendedprice', 'unit_price'))})
SELECT out_l_extendedprice AS outliers_l_extendedprice, out_unit_price AS outliers_unit_price,
       out_l_extendedprice + out_unit_price AS total_anomalies
FROM ({_outliers('lines', ('l_extendedprice', 'unit_price'))})""",
    "anomaly_rows": W.with_qa(
        _anomaly_list("qa", _NUMBERS, "question_id"), f"b AS ({_bounds('qa', _NUMBERS, '0.5')})"),
    "event_anomalies": f"WITH b AS ({_bounds('events', ('value',))}) "
                       + _anomaly_list("events", ("value",), "event_id"),
    "leftover_html": r"""
SELECT count(*) FILTER (WHERE regexp_matches(html, '<[a-z]+>')) AS raw_pages,
       count(*) FILTER (WHERE regexp_matches(regexp_replace(html, '<[^>]+>', ' ', 'g'), '<[a-z]+>'))
         AS cleaned_pages FROM pages""",
    "check_verdict": _VERDICT + f" FROM ({_TURN_CHECKS})",
    "validation_run_metrics": f"""
WITH v AS ({_VERDICT} FROM ({_QA_CHECKS})),
t AS ({W.with_qa("SELECT (SELECT count(*) FROM qa) AS total_records, "
                 "(SELECT count(*) - count(DISTINCT question_id) FROM qa) AS duplicate_count, "
                 + " + ".join(f"out_{c}" for c in _NUMBERS) + " AS anomaly_count FROM o",
                 f"b AS ({_bounds('qa', _NUMBERS)})", f"o AS ({_outliers('qa', _NUMBERS)})")})
SELECT is_valid, passed_count AS passed_checks, failed_count AS failed_checks,
       warning_count AS warning_checks, total_records, anomaly_count, duplicate_count FROM v, t""",
    "gate_open": W.with_qa("SELECT question_id, quality_score FROM qa"),
    "gate_closed": "SELECT conv_id AS question_id, turn FROM conversations WHERE false",
}

COVERS = {
    "validation_checks": ("C1", "C2", "C3", "C4", "C5", "U4", "A1", "A2", "A3", "A4", "A6", "A9", "A12"),
    "failing_checks": ("C1", "U4", "A2", "A3"),
    "quality_checks": ("C2", "A1", "A2", "A3", "A4"),
    "text_checks": ("C3", "A6"),
    "distribution_checks": ("C4", "A9"),
    "anomaly_checks": ("C5", "A12", "P11"),
    "key_duplicates": ("A3",),
    "keep_first_flags": ("W4",),
    "text_lengths": ("A5", "A14", "C12"),
    "score_description": ("A7",),
    "numeric_description": ("A13", "C12"),
    "category_counts": ("A15",),
    "order_category_counts": ("A15",),
    "top_tags": ("A8", "O2"),
    "error_frequency": ("A10",),
    "distinct_tags": ("A9", "U3"),
    "price_bounds": ("A11",),
    "price_outlier_counts": ("A12", "J5"),
    "anomaly_rows": ("C5", "J5"),
    "event_anomalies": ("C5", "J5"),
    "leftover_html": ("P11",),
    "check_verdict": ("A29", "C13"),
    "validation_run_metrics": ("A30", "C13"),
    "gate_open": ("S11",),
    "gate_closed": ("S11",),
}
