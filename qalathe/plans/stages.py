"""The whole chain, each stage handing a Parquet table to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import defaults as D
from .. import sources
from ..operators import beside, best_first
from ..sources import optional_json, write_csv, write_json, write_jsonl, write_table
from . import acquire, alerts, bias, preprocess, profile, training, validate


def run_summary(pairs: DataFrame, processed: DataFrame, examples: DataFrame) -> DataFrame:
    """One row: records acquired and processed, and examples made."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    first = beside(count(pairs, "records_acquired"), count(processed, "records_processed"))
    return beside(first, count(examples, "training_examples"))


def run_stages(
    spark: SparkSession, pairs: DataFrame, out: str, run_time,
    apply_mitigation: bool = True, test_ratio: float = D.TEST_RATIO, output_format: str = "chat",
    min_rows: int = D.MIN_ROWS, min_samples: int | None = None, sort_processed: bool = True,
    max_rows: int | None = D.MAX_ROWS,
) -> dict[str, str]:
    """Runs every stage from pairs to training sets under the folder ``out``.

    Each stage reads the table the one before has written, so a lost executor costs one stage at
    most. An invalid table is not promoted; bias and training then read the processed one of this
    run, whatever an earlier run has left. ``max_rows`` of None expects no upper bound.
    New alerts join those that earlier runs left in the history.
    ``sort_processed`` writes that table best pairs first, which costs one shuffle of the texts
    and serves readers only; no later stage needs it.
    """
    place = {name: f"{out.rstrip('/')}/{name}" for name in (
        "pairs", "processed", "processed_csv", "validated", "checks", "anomalies", "statistics",
        "profile", "expectations", "slices", "suggestions", "training_rows", "train", "test",
        "training_statistics", "alerts", "summary", "history", "text_statistics", "categories", "tags",
        "common_texts", "dataset_info", "feature_statistics", "shares", "bias_metrics", "bias_summary")}

    write_table(pairs, place["pairs"])
    pairs = spark.read.parquet(place["pairs"])
    cleaned = preprocess.preprocess(pairs, run_time)
    write_table(best_first(cleaned) if sort_processed else cleaned, place["processed"])
    processed = spark.read.parquet(place["processed"])
    write_csv(processed, place["processed_csv"])

    write_table(validate.validation_checks(processed, min_rows), place["checks"])
    checks = spark.read.parquet(place["checks"])
    write_table(validate.anomalies(processed), place["anomalies"])
    write_json(validate.describe_numbers(processed), place["statistics"])
    write_json(profile.column_profile(processed), place["profile"])
    write_json(
        profile.check_expectations(processed, profile.table_expectations(min_rows, max_rows)), place["expectations"])
    write_json(validate.describe_texts(processed), place["text_statistics"])
    write_json(validate.category_counts(processed), place["categories"])
    write_json(validate.top_tags(processed), place["tags"])
    write_json(profile.common_texts(processed), place["common_texts"])
    write_json(profile.dataset_info(processed), place["dataset_info"])
    write_json(preprocess.feature_statistics(processed), place["feature_statistics"])
    promoted = validate.promote(processed, checks, place["validated"])

    table = validate.read_validated(spark, place["validated"]) if promoted else processed
    report = bias.bias_report(table, min_samples)
    write_table(report["slices"], place["slices"])
    verdicts = spark.read.parquet(place["slices"])
    write_json(bias.slice_shares(table, min_samples=min_samples), place["shares"])
    write_json(bias.bias_run_metrics(verdicts), place["bias_metrics"])
    write_json(bias.bias_summary(verdicts), place["bias_summary"])
    write_table(bias.suggestions(verdicts), place["suggestions"])
    suggestions = spark.read.parquet(place["suggestions"])

    write_table(
        training.training_rows(table, suggestions, apply_mitigation, test_ratio), place["training_rows"])
    rows = spark.read.parquet(place["training_rows"])
    for split in ("train", "test"):
        part = rows.where(F.col("split") == split).drop("split")
        write_jsonl(training.training_examples(part, output_format), place[split])
    write_json(training.training_statistics(rows), place["training_statistics"])

    anomalies = spark.read.parquet(place["anomalies"])
    new = alerts.derive_alerts(checks, anomalies, verdicts, run_time)
    write_json(alerts.route(new), place["alerts"])
    _extend_history(spark, new, place["history"])
    write_json(run_summary(pairs, processed, rows), place["summary"])
    return place


def _extend_history(spark: SparkSession, new: DataFrame, path: str) -> None:
    """The history with the new alerts, in a version of its own; the last version is the valid one."""
    versions = optional_json(spark, f"{path}/*/version", "at long")
    last = versions.agg(F.max("at")).first()[0] if versions is not None else None
    version = 0 if last is None else last + 1
    kept = new if last is None else alerts.append_history(spark.read.parquet(f"{path}/{last}/rows"), new)
    write_table(kept, f"{path}/{version}/rows")
    write_json(spark.range(1).select(F.lit(version).cast("long").alias("at")), f"{path}/{version}/version")


def run_from_landed(
    spark: SparkSession, questions_path, answers_path, out: str, run_time,
    lines: bool = False, **options,
) -> dict[str, str]:
    """As :func:`run_stages`, from landed API responses."""
    questions = acquire.distinct_landed_questions(sources.landed_questions(spark, questions_path, lines=lines))
    answers = acquire.distinct_landed_answers(sources.landed_answers(spark, answers_path, lines=lines))
    return run_stages(spark, acquire.pairs_by_accepted_answer(questions, answers), out, run_time, **options)


def run_from_csv(
    spark: SparkSession, questions_path, answers_path, out: str, run_time,
    min_score: int = D.MIN_SCORE, **options,
) -> dict[str, str]:
    """As :func:`run_stages`, from the two CSV dumps."""
    questions = acquire.wellformed_questions(sources.read_questions_csv(spark, questions_path), min_score)
    answers = acquire.wellformed_answers(sources.read_answers_csv(spark, answers_path))
    return run_stages(spark, acquire.pairs_by_question(questions, answers), out, run_time, **options)
