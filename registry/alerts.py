"""Alert rows, their channels and their history."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalathe.plans import alerts as plan
from qalathe.plans import bias, validate

from . import working as W
from .bias import _MEM, _judged
from .validate import _NUMBERS, _TURN_CHECKS, _bounds, _outliers, _turns_as_questions
from .working import RUN_TIME, given, qa_stage


def _flat(df):
    """Details as one text, names in order."""
    entries = F.array_sort(F.map_entries("details"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return df.withColumn("details", text).drop("timestamp")


def _alerts(spark, sf_dir):
    table = qa_stage(spark, sf_dir)
    checks = validate.validation_checks(_turns_as_questions(spark, sf_dir))
    verdicts = bias.bias_verdicts(
        bias.slice_metrics(table, 1, median=False), bias.overall_metrics(table, median=False), 0.05)
    return plan.derive_alerts(checks, validate.anomalies(table, factor=0.5), verdicts, RUN_TIME)


def derived_alerts(spark, sf_dir):
    return _flat(_alerts(spark, sf_dir))


def routed_alerts(spark, sf_dir):
    return plan.route(_alerts(spark, sf_dir)).select("type", "severity", "channel")


def _history(spark, sf_dir):
    """Error events as past alerts, their severity by value."""
    events = given(spark, sf_dir, "events").where("event_type = 'error'")
    severity = F.when(F.col("value") > 20, "critical").when(F.col("value") > 10, "error").when(
        F.col("value") > 5, "warning").otherwise("info")
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit("data_quality_issue").alias("type"),
        severity.alias("severity"), F.lit("Event").alias("title"),
        F.col("event_id").cast("string").alias("message"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("details"), "event_id")


def routed_history(spark, sf_dir):
    routed = plan.route(_history(spark, sf_dir), ("slack", "email"))
    return routed.groupBy("channel", "severity").agg(F.count("*").alias("n"))


def kept_history(spark, sf_dir):
    turns = _turns_as_questions(spark, sf_dir)
    new = plan.validation_alert(validate.quality_checks(turns), RUN_TIME)
    kept = plan.append_history(_history(spark, sf_dir), new, ties=("event_id",))
    return kept.select("type", "severity", "message")


QUERIES = {
    "derived_alerts": derived_alerts,
    "routed_alerts": routed_alerts,
    "routed_history": routed_history,
    "kept_history": kept_history,
}

_DERIVED = W.with_qa("""
SELECT 'validation_failure' AS "type", 'error' AS severity, 'Data Validation Failed' AS title,
  'Data validation failed with ' || failed || ' check(s).' AS message,
  'failed_checks=' || names || '; total_failures=' || failed AS details FROM v WHERE failed > 0
UNION ALL SELECT 'anomaly_detected', 'warning', 'Data Anomalies Detected',
  'Found ' || total || ' anomalies in the data.', 'anomaly_count=' || total || '; types=outlier' FROM o WHERE total > 0
UNION ALL SELECT 'bias_detected', CASE WHEN high > 0 THEN 'error' ELSE 'warning' END, 'Data Bias Detected',
  'Bias detected in ' || biased || ' data slice(s).',
  'biased_slices=' || slices || '; high_severity=' || high || '; low_severity=' || low
  || '; medium_severity=' || medium FROM s WHERE biased > 0""",
    f"""v AS (SELECT count(*) AS failed, string_agg("check", ', ' ORDER BY ordinal) FILTER (WHERE r <= 5) AS names
  FROM (SELECT *, row_number() OVER (ORDER BY ordinal) AS r FROM ({_TURN_CHECKS}) WHERE status = 'fail'))""",
    f"b AS ({_bounds('qa', _NUMBERS, '0.5')})",
    "o AS (SELECT " + " + ".join(f"out_{c}" for c in _NUMBERS) + f" AS total FROM ({_outliers('qa', _NUMBERS)}))",
    _MEM, _judged(least=1, limit=0.05).replace("o AS (SELECT CAST", "ov AS (SELECT CAST").replace("FROM raw, o)", "FROM raw, ov)"),
    """s AS (SELECT count(*) FILTER (WHERE nf > 0) AS biased, count(*) FILTER (WHERE severity = 'high') AS high,
  count(*) FILTER (WHERE severity = 'medium') AS medium, count(*) FILTER (WHERE severity = 'low') AS low,
  string_agg(slice, ', ' ORDER BY place) FILTER (WHERE nf > 0 AND place <= 5) AS slices
  FROM (SELECT *, row_number() OVER (ORDER BY nf = 0, list_position(['question_type', 'complexity', 'tags',
    'error_signatures', 'infra_components'], dimension), value) AS place FROM judged))""")

_HISTORY = """h AS (SELECT 'data_quality_issue' AS "type", CASE WHEN value > 20 THEN 'critical' WHEN value > 10 THEN 'error'
  WHEN value > 5 THEN 'warning' ELSE 'info' END AS severity, CAST(event_id AS VARCHAR) AS message, ts, event_id
  FROM events WHERE event_type = 'error')"""

ORACLE = {
    "derived_alerts": _DERIVED,
    "routed_alerts": f"""
SELECT "type", severity, channel FROM ({_DERIVED}), (VALUES ('log', 0), ('slack', 1), ('email', 2)) AS c(channel, least)
WHERE CASE severity WHEN 'info' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END >= least""",
    "routed_history": f"""
WITH {_HISTORY} SELECT 'slack' AS channel, severity, count(*) AS n FROM h WHERE severity <> 'info' GROUP BY severity
UNION ALL SELECT 'email', severity, count(*) FROM h WHERE severity IN ('error', 'critical') GROUP BY severity""",
    "kept_history": f"""
WITH {_HISTORY}, f AS (SELECT count(*) AS n FROM ({_TURN_CHECKS}) WHERE status = 'fail' AND ordinal BETWEEN 200 AND 299)
SELECT 'validation_failure' AS "type", 'error' AS severity, 'Data validation failed with ' || n || ' check(s).' AS message FROM f
UNION ALL (SELECT "type", severity, message FROM h ORDER BY ts DESC, event_id DESC LIMIT 999)""",
}

COVERS = {
    "derived_alerts": ("L1", "O5"),
    "routed_alerts": ("L2",),
    "routed_history": ("L2",),
    "kept_history": ("L3", "O4"),
}
