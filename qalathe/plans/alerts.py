"""Alert rows from check, outlier and bias tables, their channels and their history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..operators import beside
from .bias import bias_summary, dimension_order
from .checks import verdict

CHANNELS = ("slack", "email", "log")
_COLUMNS = ("timestamp", "type", "severity", "title", "message", "details")


def _alert(df: DataFrame, at, kind, severity, title, message, details: dict[str, Column]) -> DataFrame:
    pairs = [x for name, value in details.items() for x in (F.lit(name), value.cast("string"))]
    return df.select(
        F.lit(at).cast("timestamp").alias("timestamp"), F.lit(kind).alias("type"),
        severity.alias("severity"), F.lit(title).alias("title"), message.alias("message"),
        F.create_map(*pairs).alias("details"))


def _first_names(df: DataFrame, order: list[Column], name: str, k: int = 5) -> DataFrame:
    """One row: the first k names joined by commas. A top-k, so no task collects all names."""
    top = df.select(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)],
                             F.col(name).alias("_name")).alias("_entry"))
    top = top.orderBy("_entry").limit(k)
    entries = F.array_sort(F.collect_list("_entry"))
    return top.agg(F.concat_ws(", ", F.transform(entries, lambda e: e["_name"])).alias("_names"))


# Fixed texts: titles and messages of alerts, by which they are compared and searched.

def validation_alert(checks: DataFrame, at) -> DataFrame:
    """One error when the table is not valid, none otherwise."""
    names = _first_names(checks.where(F.col("status") == "fail"),
                         [F.col("ordinal"), F.coalesce("column", F.lit(""))], "check")
    row = beside(verdict(checks), names).where(~F.col("is_valid"))
    n = F.col("failed_count")
    return _alert(
        row, at, "validation_failure", F.lit("error"), "Data Validation Failed",
        F.concat(F.lit("Data validation failed with "), n, F.lit(" check(s).")),
        {"failed_checks": F.col("_names"), "total_failures": n})


def anomaly_alert(anomalies: DataFrame, at) -> DataFrame:
    """One warning when there are anomalies, none otherwise."""
    counts = anomalies.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    names = _first_names(counts, [F.col("type")], "type")
    row = beside(total, names).where(F.col("n") > 0)
    types = F.when(F.col("_names") == "", "unknown").otherwise(F.col("_names"))
    return _alert(
        row, at, "anomaly_detected", F.lit("warning"), "Data Anomalies Detected",
        F.concat(F.lit("Found "), F.col("n"), F.lit(" anomalies in the data.")),
        {"anomaly_count": F.col("n"), "types": types})


def bias_alert(verdicts: DataFrame, at) -> DataFrame:
    """One alert when a slice is biased: an error if one is so to a high degree, else a warning."""
    names = _first_names(verdicts.where("is_biased"), [dimension_order(), F.col("value")], "slice")
    row = beside(bias_summary(verdicts), names).where(F.col("biased_slices") > 0)
    counts = {s: F.col(f"{s}_severity_count") for s in ("high", "medium", "low")}
    return _alert(
        row, at, "bias_detected", F.when(counts["high"] > 0, "error").otherwise("warning"),
        "Data Bias Detected",
        F.concat(F.lit("Bias detected in "), F.col("biased_slices"), F.lit(" data slice(s).")),
        {"biased_slices": F.col("_names"), **{f"{s}_severity": c for s, c in counts.items()}})


def derive_alerts(checks: DataFrame, anomalies: DataFrame, verdicts: DataFrame, at) -> DataFrame:
    """The alerts of one run."""
    return reduce(DataFrame.unionByName, [
        validation_alert(checks, at), anomaly_alert(anomalies, at), bias_alert(verdicts, at)])


def route(alerts: DataFrame, channels=CHANNELS) -> DataFrame:
    """One row per alert and channel: log takes all, chat all but infos, mail errors and worse."""
    rules = {
        "log": F.lit(True),
        "slack": F.col("severity") != "info",
        "email": F.col("severity").isin("error", "critical"),
    }
    targets = F.array(*[
        F.when(rules[c], F.lit(c)) for c in rules if c in channels
    ]) if channels else F.array().cast("array<string>")
    return alerts.withColumn("channel", F.explode(targets)).where(F.col("channel").isNotNull())


def append_history(
    history: DataFrame, alerts: DataFrame, keep: int = D.ALERT_HISTORY_ROWS, ties: tuple[str, ...] = (),
) -> DataFrame:
    """The last ``keep`` alerts of history and new ones together; ``ties``, then all columns, order equal times."""
    columns = [*_COLUMNS, *[t for t in ties if t not in _COLUMNS]]
    both = history.select(*columns).withColumn("_new", F.lit(0)).unionByName(
        alerts.select(*_COLUMNS).withColumn("_new", F.lit(1)), allowMissingColumns=True)
    order = [F.desc("_new"), F.desc("timestamp"), *[F.desc(t) for t in ties], F.desc(F.to_json(F.struct(*_COLUMNS)))]
    return both.orderBy(*order).limit(keep).drop("_new")
