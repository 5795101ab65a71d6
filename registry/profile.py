"""Column profiles and expectation suites."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalathe.plans import profile as plan

from . import working as W
from .validate import _rounded
from .working import given, given_wide, qa_base, qa_stage


def _profiled(df, digits=6):
    out = _rounded(plan.column_profile(df), digits)
    return out.withColumns({
        "ordinal": F.col("ordinal").cast("long"), "unique_count": F.col("unique_count").cast("double"),
        # A session may read the files with or without a time zone.
        "dtype": F.replace("dtype", F.lit("timestamp_ntz"), F.lit("timestamp"))})


def order_profile(spark, sf_dir):
    return _profiled(given(spark, sf_dir, "orders"), 4)


def line_profile(spark, sf_dir):
    return _profiled(given_wide(spark, sf_dir, "lineitem"), 4)


def label_profile(spark, sf_dir):
    """Every document with its label where it has one: columns with many nulls."""
    docs, labels = given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    return _profiled(docs.join(labels, "doc_id", "left").withColumn(
        "never", F.lit(None).cast("double")).select("doc_id", "text", "lang", "quality", "toxic", "never"))


def common_values(spark, sf_dir):
    docs = given(spark, sf_dir, "documents").select("text", "lang", "source")
    return plan.common_texts(docs)


def common_order_values(spark, sf_dir):
    long_status = F.concat(F.repeat(F.lit("status of the order "), 5), F.col("o_orderstatus"))
    return plan.common_texts(given(spark, sf_dir, "orders").withColumn("long_status", long_status))


def table_info(spark, sf_dir):
    """Whole turns, with a nested column, each twice for every third conversation."""
    turns = given(spark, sf_dir, "conversations").withColumn("pair", F.array("role", "text"))
    return plan.dataset_info(turns.unionByName(turns.where("conv_id % 3 = 0")))


def common_long_values(spark, sf_dir):
    """Long values with equal counts: more of them are tied than wanted."""
    orders = given(spark, sf_dir, "orders").where("o_orderkey % 17 < 12").select(
        "o_orderkey", F.concat(F.repeat(F.lit("delivery note of the class "), 4), F.chr(97 + F.col("o_orderkey") % 17)).alias("note"))
    return plan.common_texts(orders.select("note").distinct(), k=5)


def document_copies(spark, sf_dir):
    return plan.dataset_info(given(spark, sf_dir, "documents").select("text", "lang"))


def _results(df):
    return df.withColumn("ordinal", F.col("ordinal").cast("long"))


def declared_checks(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    return _results(plan.check_expectations(table, plan.declared_expectations(), skip_absent=True))


def declared_checks_all_keys(spark, sf_dir):
    table = qa_base(spark, sf_dir).withColumn("quality_score", F.col("answer_score").cast("double"))
    return _results(plan.check_expectations(table, plan.declared_expectations(every_key=True), skip_absent=True))


def expectation_suite(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("question_id"), F.col("l_returnflag").alias("question_body"),
        (F.col("l_quantity") - 10).alias("score"), F.col("l_extendedprice").alias("quality_score"))
    return _results(plan.check_expectations(lines, plan.table_expectations()))


def expectation_metrics(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    results = plan.check_expectations(table, plan.declared_expectations(), skip_absent=True)
    return plan.expectation_metrics(table, results)


QUERIES = {
    "order_profile": order_profile,
    "lineitem_profile": line_profile,
    "label_profile": label_profile,
    "common_values": common_values,
    "common_order_values": common_order_values,
    "common_long_values": common_long_values,
    "table_info": table_info,
    "document_copies": document_copies,
    "declared_schema_checks": declared_checks,
    "declared_schema_checks_all_keys": declared_checks_all_keys,
    "expectation_suite": expectation_suite,
    "expectation_metrics": expectation_metrics,
}


# --- SQL ------------------------------------------------------------------------------

def _profile_sql(table: str, columns: list[tuple[str, str, str]], digits: int = 6) -> str:
    """``columns``: name, kind (number, text or other), type name."""
    rows = []
    for i, (c, kind, dtype) in enumerate(columns):
        d = f"CAST({c} AS DOUBLE)"
        number = kind == "number"
        text = kind == "text"

        def pick(on: bool, sql: str, name: str) -> str:
            value = f"round(CAST({sql} AS DOUBLE), {digits})" if on else "CAST(NULL AS DOUBLE)"
            return f"{value} AS {name}"

        rows.append(
            f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS \"column\", '{dtype}' AS dtype,"
            f" count({c}) AS \"count\", count(*) - count({c}) AS null_count,"
            f" round((count(*) - count({c})) / count(*) * 100, {digits}) AS null_percentage, "
            + ", ".join([
                pick(number, f"avg({d})", "mean"), pick(number, f"stddev_samp({d})", "std"),
                pick(number, f"min({d})", "min"), pick(number, f"max({d})", "max"),
                pick(number, f"quantile_cont({d}, 0.5)", "median"),
                pick(number, f"quantile_cont({d}, 0.25)", "q25"),
                pick(number, f"quantile_cont({d}, 0.75)", "q75"),
                pick(text, f"count(DISTINCT {c})", "unique_count"),
                pick(text, f"min(length({c}))", "min_length"),
                pick(text, f"max(length({c}))", "max_length"),
                pick(text, f"avg(length({c}))", "mean_length"),
            ]) + f" FROM {table}")
    return "\nUNION ALL ".join(rows)


_ORDERS = [
    ("o_orderkey", "number", "bigint"), ("o_custkey", "number", "bigint"),
    ("o_orderstatus", "text", "string"), ("o_totalprice", "number", "double"),
    ("o_orderdate", "other", "timestamp"), ("o_orderpriority", "text", "string"),
]
_LINEITEM = [
    ("l_orderkey", "number", "bigint"), ("l_partkey", "number", "bigint"),
    ("l_suppkey", "number", "bigint"), ("l_linenumber", "number", "int"),
    ("l_quantity", "number", "double"), ("l_extendedprice", "number", "double"),
    ("l_discount", "number", "double"), ("l_tax", "number", "double"),
    ("l_returnflag", "text", "string"), ("l_linestatus", "text", "string"),
    ("l_shipdate", "other", "timestamp"),
]


def _common_sql(table: str, columns) -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns)
    return f"""
SELECT "column", value, n FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank,
         count(*) OVER (PARTITION BY "column") AS distinct_values FROM ({parts}))
WHERE rank <= 5 AND distinct_values < 100"""


def _rule(i, check, column, ok, value, threshold, severity="error", table="m") -> str:
    column = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT CAST({i} AS BIGINT) AS ordinal, '{check}' AS \"check\", CAST({column} AS VARCHAR) AS \"column\","
        f" CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status,"
        f" CASE WHEN {ok} THEN 'info' ELSE '{severity}' END AS severity,"
        f" CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold FROM {table}")


_COLUMNS = ("question_id", "title", "question_body", "answer_body", "tags", "score", "answer_score",
            "quality_score")
_LIMITS = {"question_id": 1, "score": 0, "answer_score": 0, "quality_score": 0}
_LENGTHS = {"title": (5, 500), "question_body": (20, None), "answer_body": (50, None)}


def _declared_sql(every_key: bool) -> str:
    rows, i = [], 0

    def add(*args, **kw):
        nonlocal i
        rows.append(_rule(i, *args, **kw))
        i += 1

    add("required_columns", None, "true", 0, "NULL")
    add("min_row_count", None, "n >= 100" + (" AND n <= 1000000" if every_key else ""), "n", 100)
    for c in _COLUMNS:
        add(f"{c}_not_null", c, "true" if c == "answer_score" else f"null_{c} = 0", f"null_{c}", "NULL")
        if c == "question_id":
            add("question_id_unique", c, "copies = 0", "copies", "NULL")
        if c in _LIMITS:
            add(f"{c}_min_value", c, f"NOT coalesce(min_{c} < {_LIMITS[c]}, false)", f"min_{c}", _LIMITS[c],
                severity="warning")
        if every_key:
            add(f"{c}_type", c, "true", "NULL", "NULL")
            if c in _LENGTHS:
                low, high = _LENGTHS[c]
                ok = f"short_{c} >= {low}" + (f" AND long_{c} <= {high}" if high else "")
                add(f"{c}_length", c, ok, f"short_{c}", low, severity="warning")
    return "\nUNION ALL ".join(rows)


_DECLARED_MEASURES = (
    "count(*) AS n, count(*) - count(DISTINCT question_id) AS copies, "
    + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in _COLUMNS)
    + ", " + ", ".join(f"min({c}) AS min_{c}" for c in _LIMITS)
    + ", " + ", ".join(f"min(length({c})) AS short_{c}, max(length({c})) AS long_{c}" for c in _LENGTHS))

_DECLARED = W.with_qa(_declared_sql(False), f"m AS (SELECT {_DECLARED_MEASURES} FROM qa)")

ORACLE = {
    "order_profile": _profile_sql("orders", _ORDERS, 4),
    "lineitem_profile": _profile_sql("lineitem", _LINEITEM, 4),
    "label_profile": """
WITH d AS (SELECT documents.doc_id, text, lang, quality, toxic, CAST(NULL AS DOUBLE) AS never
           FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id)
""" + _profile_sql("d", [
        ("doc_id", "number", "bigint"), ("text", "text", "string"), ("lang", "text", "string"),
        ("quality", "number", "int"), ("toxic", "number", "int"), ("never", "number", "double")]),
    "common_values": _common_sql("documents", ("text", "lang", "source")),
    "common_order_values": """
WITH o AS (SELECT *, repeat('status of the order ', 5) || o_orderstatus AS long_status FROM orders)
""" + _common_sql("o", ("o_orderstatus", "o_orderpriority", "long_status")),
    "table_info": """
WITH t AS (SELECT *, [role, text] AS pair FROM conversations),
u AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE conv_id % 3 = 0)
SELECT count(*) AS row_count, CAST(5 AS BIGINT) AS column_count, 'conv_id,turn,role,text,pair' AS "columns",
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM u)) AS duplicate_rows FROM u""",
    "common_long_values": """
SELECT DISTINCT 'note' AS "column", repeat('delivery note of the class ', 4) || chr(CAST(97 + o_orderkey % 17 AS INT)) AS value,
       CAST(1 AS BIGINT) AS n
FROM orders WHERE o_orderkey % 17 < 12 ORDER BY value LIMIT 5""",
    "document_copies": """
SELECT (SELECT count(*) FROM documents) AS row_count, CAST(2 AS BIGINT) AS column_count,
       'text,lang' AS "columns",
       (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents))
         AS duplicate_rows""",
    "declared_schema_checks": _DECLARED,
    "declared_schema_checks_all_keys": f"""
WITH qa_base AS (SELECT *, CAST(answer_score AS DOUBLE) AS quality_score, [lang, source] AS tags
                 FROM ({W.QA_BASE_SQL})),
m AS (SELECT {_DECLARED_MEASURES} FROM qa_base)
""" + _declared_sql(True),
    "expectation_suite": """
WITH m AS (SELECT count(*) AS n, count(*) - count(DISTINCT l_orderkey) AS copies,
  count(*) - count(l_orderkey) AS null_id, count(*) - count(l_returnflag) AS null_body,
  min(l_quantity - 10) AS min_score, min(l_extendedprice) AS min_quality FROM lineitem)
""" + "\nUNION ALL ".join([
        _rule(0, "table_row_count_between", None, "n BETWEEN 100 AND 1000000", "n", 100),
        _rule(1, "column_exists", "question_id", "true", "NULL", "NULL"),
        _rule(2, "column_exists", "question_body", "true", "NULL", "NULL"),
        _rule(3, "column_exists", "answer_body", "false", "NULL", "NULL"),
        _rule(4, "values_not_null", "question_id", "null_id = 0", "null_id", "NULL"),
        _rule(5, "values_not_null", "question_body", "null_body = 0", "null_body", "NULL"),
        _rule(6, "values_not_null", "answer_body", "false", "NULL", "NULL"),
        _rule(7, "values_unique", "question_id", "copies = 0", "copies", "NULL"),
        _rule(8, "values_between", "score", "min_score >= 0", "min_score", 0),
        _rule(9, "values_between", "quality_score", "min_quality >= 0", "min_quality", 0),
    ]),
    "expectation_metrics": f"""
SELECT count(*) FILTER (WHERE status = 'fail' AND severity = 'error') = 0 AS schema_valid,
       count(*) FILTER (WHERE status = 'pass') AS checks_passed,
       count(*) FILTER (WHERE status = 'fail') AS checks_failed,
       CAST(max(value) FILTER (WHERE "check" = 'min_row_count') AS BIGINT) AS row_count,
       CAST(16 AS BIGINT) AS column_count FROM ({_DECLARED})""",
}

COVERS = {
    "order_profile": ("A16", "A17", "A18", "C12"),
    "lineitem_profile": ("A16", "A17", "A18", "C12"),
    "label_profile": ("A16", "A17", "A18"),
    "common_values": ("A18", "O2"),
    "common_order_values": ("A18", "O2"),
    "common_long_values": ("A18", "O2"),
    "table_info": ("A19",),
    "document_copies": ("A19",),
    "declared_schema_checks": ("C6", "C7", "C8", "C9", "C10", "C11"),
    "declared_schema_checks_all_keys": ("C6", "C7", "C8", "C9", "C10", "C11"),
    "expectation_suite": ("C6", "C7", "C8", "C9", "C10", "C11"),
    "expectation_metrics": ("C11", "C13"),
}
