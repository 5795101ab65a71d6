"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
"""

from __future__ import annotations

import json
import os
import re
import time

from qalathe.plans import bias, training, validate
from qalathe.session import fresh_path, local_session
from qalathe.sources import write_table
from registry import QUERIES
from registry.working import qa_processed

HEADLINES = (
    "question_type_quality", "processed_records", "feature_statistics", "cleaned_pages", "csv_pairs",
    "landed_pairs", "validation_checks", "text_lengths", "price_bounds", "price_outlier_counts",
    "event_anomalies", "numeric_description", "lineitem_profile", "order_profile", "document_copies",
    "expectation_suite", "slice_metrics", "bias_verdicts", "mitigation_suggestions", "resampled_counts",
    "split_rows", "stratified_split", "chat_messages", "completion_examples", "training_statistics",
    "derived_alerts", "kept_history",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def _best(action, runs: int = 3) -> float:
    """Shortest of several runs, for what is compared with a rate: without first-use compilation."""
    return min(_timed(action) for _ in range(runs))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    _run(QUERIES["question_type_quality"](spark, sf_dir))  # starts the JVM and its workers

    times = {name: _timed(lambda: _run(QUERIES[name](spark, sf_dir))) for name in HEADLINES}

    # The stages one by one over their stage table, as a run meets them.
    path = fresh_path(spark, "processed")
    times["stage_preprocess"] = _timed(lambda: write_table(qa_processed(spark, sf_dir), path))
    table = spark.read.parquet(path)
    rows = table.count()
    times["stage_validate"] = _best(lambda: _run(validate.validation_checks(table)))
    times["stage_bias"] = _best(lambda: _run(bias.bias_report(table)["slices"]))
    times["stage_training"] = _best(lambda: _run(training.training_examples(training.training_rows(table))))

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else sf_dir,
        "processed_rows": rows,
        "validate_rows_per_sec": round(rows / times["stage_validate"], 1),
    }))


if __name__ == "__main__":
    main()
