"""Schema, quality, text and distribution checks, outliers, statistics and the promotion gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults as D
from ..functions import has_leftover_tags, is_blank
from ..operators import beside, column_quantiles, duplicate_summary, most_frequent, value_counts
from ..sources import write_table
from .checks import Suite, check_row, percent, run_suites, share, verdict

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _present(df: DataFrame, columns) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _name_list(names) -> str:
    return "{" + ", ".join(repr(n) for n in sorted(names)) + "}"


# --- suites ---------------------------------------------------------------------------

def schema_suite(df: DataFrame, required=D.REQUIRED_COLUMNS, known=D.KNOWN_COLUMNS) -> Suite:
    """Column names against the required and the known ones; needs no rows."""
    missing, extra = set(required) - set(df.columns), set(df.columns) - set(known)
    check = "schema_required_columns"
    n = float(len(missing))
    if missing:
        facts = [(100, check, None, "fail", "error", n, 0.0,
                  f"Missing required columns: {_name_list(missing)}")]
    else:
        facts = [(100, check, None, "pass", "info", n, 0.0, "All required columns present")]
    if extra:
        facts.append((101, "schema_extra_columns", None, "warn", "warning", float(len(extra)), 0.0,
                      f"Unexpected columns found: {_name_list(extra)}"))
    return Suite(facts=facts)


# Fixed texts: the messages of the checks below, by which reports are compared.

def quality_suite(
    df: DataFrame, key: str = "question_id", critical=D.CRITICAL_COLUMNS,
    texts=("question_body", "answer_body", "title"), min_rows: int = D.MIN_ROWS,
    max_missing: float = D.MAX_MISSING_RATIO, max_duplicates: float = D.MAX_DUPLICATE_RATIO,
) -> Suite:
    """Row count, missing values, duplicate keys and blank texts."""
    total = F.col("total_rows")
    enough = total >= min_rows
    suite = Suite(checks=[check_row(
        200, "min_rows", None, F.when(enough, "pass").otherwise("fail"), total, min_rows,
        F.when(enough, F.concat(F.lit("Row count ("), total, F.lit(f") meets minimum ({min_rows})")))
        .otherwise(F.concat(F.lit("Only "), total, F.lit(f" rows, minimum required: {min_rows}"))),
    )])
    for i, c in enumerate(_present(df, critical)):
        suite.measures[f"nulls_{c}"] = F.count_if(F.col(c).isNull())
        nulls = F.col(f"nulls_{c}")
        ratio = share(nulls, total)
        status = F.when(ratio > max_missing, "fail").when(nulls > 0, "warn").otherwise("pass")
        suite.checks.append(check_row(
            210 + i, "missing_values", c, status, ratio, max_missing,
            F.when(status == "fail", F.concat(F.lit(f"Column '{c}' has "), percent(ratio),
                                              F.lit(" missing values")))
            .when(status == "warn", F.concat(F.lit(f"Column '{c}' has "), nulls,
                                             F.lit(" missing values ("), percent(ratio), F.lit(")")))
            .otherwise(F.lit(f"Column '{c}' has no missing values")),
        ))
    if key in df.columns:
        suite.sides.append(duplicate_summary(df.select(key), key).select("duplicates"))
        copies = F.col("duplicates")
        ratio = share(copies, total)
        status = F.when(ratio > max_duplicates, "fail").when(copies > 0, "warn").otherwise("pass")
        suite.checks.append(check_row(
            220, "duplicates", key, status, ratio, max_duplicates,
            F.when(status == "fail", F.concat(F.lit("Found "), copies, F.lit(f" duplicate {key}s ("),
                                              percent(ratio), F.lit(")")))
            .when(status == "warn", F.concat(F.lit("Found "), copies, F.lit(" duplicates")))
            .otherwise(F.lit(f"No duplicate {key}s found")),
        ))
    for i, c in enumerate(_present(df, texts)):
        suite.measures[f"blanks_{c}"] = F.count_if(is_blank(c))
        blanks = F.col(f"blanks_{c}")
        suite.checks.append(check_row(
            230 + i, "empty_strings", c, F.when(blanks > 0, "warn"), blanks, 0,
            F.concat(F.lit(f"Column '{c}' has "), blanks, F.lit(" empty strings")),
        ))
    return suite


def text_suite(
    df: DataFrame, question: str = "question_body", answer: str = "answer_body",
    short_question: int = D.SHORT_QUESTION_CHARS, short_answer: int = D.SHORT_ANSWER_CHARS,
    max_share: float = D.SHORT_TEXT_SHARE,
) -> Suite:
    """Too many very short texts? Only the question check reports a pass."""
    suite = Suite()
    for i, (c, noun, limit) in enumerate(
            ((question, "question", short_question), (answer, "answer", short_answer))):
        if c not in df.columns:
            continue
        suite.measures[f"short_{noun}"] = F.count_if(F.length(c) < limit)
        short = F.col(f"short_{noun}")
        many = short > F.col("total_rows") * F.lit(max_share)
        status = F.when(many, "warn")
        fine = F.lit(None).cast("string")
        if noun == "question":
            status, fine = status.otherwise("pass"), F.lit("Question lengths are acceptable")
        suite.checks.append(check_row(
            300 + i, "text_quality", c, status, short, max_share,
            F.when(many, F.concat(short, F.lit(f" {noun}s are very short (<{limit} chars)")))
            .otherwise(fine),
        ))
    return suite


def distribution_suite(
    df: DataFrame, score: str = "score", tags: str = "tags", min_tags: int = D.MIN_DISTINCT_TAGS,
) -> Suite:
    """Scores without spread, too few tags."""
    suite = Suite()
    if score in df.columns:
        suite.measures["score_std"] = F.stddev_samp(score)
        flat = F.col("score_std") == 0
        suite.checks.append(check_row(
            400, "feature_distribution", score, F.when(flat, "warn"), F.col("score_std"), 0,
            F.lit("All scores are identical")))
    if tags in df.columns:
        suite.sides.append(value_counts(df, tags).agg(F.count(F.lit(1)).alias("distinct_tags")))
        distinct = F.col("distinct_tags")
        suite.checks.append(check_row(
            401, "feature_distribution", tags, F.when(distinct < min_tags, "warn"), distinct, min_tags,
            F.lit("Very few unique tags found")))
    return suite


def anomaly_suite(
    df: DataFrame, columns=D.OUTLIER_COLUMNS, factor: float = D.IQR_FACTOR,
    max_share: float = D.OUTLIER_SHARE, text: str = "question_body",
) -> Suite:
    """Columns with many outliers, texts with left-over tags."""
    suite = Suite()
    columns = _present(df, columns)
    if columns:
        suite.sides.append(outlier_counts(df, columns, factor))
        for i, c in enumerate(columns):
            n = F.col(f"outliers_{c}")
            suite.checks.append(check_row(
                500 + i, "anomaly_detection", c,
                F.when(n > F.col("total_rows") * F.lit(max_share), "warn"), n, max_share,
                F.concat(F.lit("Found "), n, F.lit(f" outliers in '{c}'"))))
    if text in df.columns:
        suite.measures["leftover_html"] = F.count_if(has_leftover_tags(text))
        n = F.col("leftover_html")
        suite.checks.append(check_row(
            520, "anomaly_detection", text, F.when(n > 0, "warn"), n, 0,
            F.concat(F.lit("Found "), n, F.lit(" records with uncleaned HTML"))))
    return suite


def schema_checks(df: DataFrame, **options) -> DataFrame:
    return run_suites(df, [schema_suite(df, **options)])


def quality_checks(df: DataFrame, **options) -> DataFrame:
    return run_suites(df, [quality_suite(df, **options)])


def text_checks(df: DataFrame, **options) -> DataFrame:
    return run_suites(df, [text_suite(df, **options)])


def distribution_checks(df: DataFrame, **options) -> DataFrame:
    return run_suites(df, [distribution_suite(df, **options)])


def anomaly_checks(df: DataFrame, **options) -> DataFrame:
    return run_suites(df, [anomaly_suite(df, **options)])


def validation_checks(df: DataFrame, min_rows: int = D.MIN_ROWS) -> DataFrame:
    """All five suites; the plain aggregates of all of them share one pass."""
    return run_suites(df, [
        schema_suite(df), quality_suite(df, min_rows=min_rows), text_suite(df),
        distribution_suite(df), anomaly_suite(df),
    ])


# --- outliers -------------------------------------------------------------------------

def iqr_bounds(
    df: DataFrame, columns=D.OUTLIER_COLUMNS, factor: float = D.IQR_FACTOR, approximate: bool = False,
) -> DataFrame:
    """Quartiles and outlier bounds, one row per column."""
    q = column_quantiles(df, _present(df, columns), {"q25": 0.25, "q75": 0.75}, approximate)
    spread = F.col("q75") - F.col("q25")
    return q.select(
        "column", "q25", "q75",
        (F.col("q25") - F.lit(factor) * spread).alias("lower_bound"),
        (F.col("q75") + F.lit(factor) * spread).alias("upper_bound"),
    )


def _with_bounds(df: DataFrame, columns, factor: float):
    """The table next to one row that holds the bounds of every column."""
    bounds = iqr_bounds(df, columns, factor)
    wide = bounds.agg(*[
        F.max(F.when(F.col("column") == c, F.col(side))).alias(f"_{side}_{c}")
        for c in columns for side in ("lower_bound", "upper_bound")
    ])
    return beside(df, wide)


def _outside(c: str) -> Column:
    return (F.col(c) < F.col(f"_lower_bound_{c}")) | (F.col(c) > F.col(f"_upper_bound_{c}"))


def outlier_counts(df: DataFrame, columns=D.OUTLIER_COLUMNS, factor: float = D.IQR_FACTOR) -> DataFrame:
    """One row: outliers per column and in total."""
    columns = _present(df, columns)
    bounded = _with_bounds(df.select(*columns), columns, factor)
    counts = bounded.agg(*[F.count_if(_outside(c)).alias(f"outliers_{c}") for c in columns])
    total = sum((F.col(f"outliers_{c}") for c in columns), F.lit(0).cast("long"))
    return counts.withColumn("total_anomalies", total)


def anomalies(
    df: DataFrame, columns=D.OUTLIER_COLUMNS, factor: float = D.IQR_FACTOR, key: str = "question_id",
) -> DataFrame:
    """One row per outlying value, with its bounds. Only outliers leave the row."""
    columns = _present(df, columns)
    bounded = _with_bounds(df.select(key, *[c for c in columns if c != key]), columns, factor)
    found = [
        F.when(_outside(c), F.struct(
            F.lit("outlier").alias("type"), F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
            F.col(f"_lower_bound_{c}").alias("lower_bound"),
            F.col(f"_upper_bound_{c}").alias("upper_bound")))
        for c in columns
    ]
    rows = bounded.select(key, F.explode(F.array(*found)).alias("_found"))
    return rows.where(F.col("_found").isNotNull()).select(
        "_found.type", "_found.column", key, "_found.value", "_found.lower_bound", "_found.upper_bound")


# --- statistics -----------------------------------------------------------------------

def describe_numbers(df: DataFrame, columns=None, approximate: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per numeric column.

    The moments of every column come from one aggregation; quartiles from :func:`column_quantiles`.
    """
    columns = numeric_columns(df) if columns is None else _present(df, columns)
    moments = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c) for c in columns
    ]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}`.{m}").alias(m)
                                             for m in ("count", "mean", "std", "min", "max")])
        for c in columns
    ])))
    # One row per column on both sides.
    quartiles = column_quantiles(df, columns, QUARTILES, approximate)
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_texts(df: DataFrame, columns=D.TEXT_COLUMNS, median: bool = False) -> DataFrame:
    """Length statistics, one row per text column."""
    columns = _present(df, columns)
    lengths = df.select(*[F.length(c).alias(c) for c in columns])
    stats = lengths.agg(*[
        F.struct(
            F.avg(c).alias("avg_length"), F.min(c).cast("long").alias("min_length"),
            F.max(c).cast("long").alias("max_length"), F.sum(c).alias("total_chars"),
        ).alias(c) for c in columns
    ]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("s"))
        for c in columns
    ]))).select("column", "s.*")
    if not median:
        return stats
    mid = column_quantiles(lengths, columns, {"median_length": 0.5})
    return stats.join(F.broadcast(mid), "column", "left")


def category_counts(df: DataFrame, columns=("question_type", "complexity")) -> DataFrame:
    """Frequency of each value of several columns, nulls skipped, as (column, value, n)."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             for c in _present(df, columns)]
    return (
        df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def top_tags(df: DataFrame, k: int = 20, column: str = "tags") -> DataFrame:
    return most_frequent(df, column, k)


# --- verdict and gate -----------------------------------------------------------------

def validation_metrics(df: DataFrame, checks: DataFrame) -> DataFrame:
    """One row of the run's key numbers."""
    duplicates = duplicate_summary(df.select("question_id"), "question_id").select(
        F.col("total_rows").alias("total_records"), F.col("duplicates").alias("duplicate_count"))
    found = outlier_counts(df).select(F.col("total_anomalies").alias("anomaly_count"))
    row = beside(beside(verdict(checks), duplicates), found)
    return row.select(
        "is_valid", F.col("passed_count").alias("passed_checks"),
        F.col("failed_count").alias("failed_checks"), F.col("warning_count").alias("warning_checks"),
        "total_records", "anomaly_count", "duplicate_count")


def gated(df: DataFrame, checks: DataFrame) -> DataFrame:
    """All rows when the checks hold, none otherwise; the verdict is one scalar subquery."""
    return df.where(verdict(checks).select("is_valid").scalar())


def promote(df: DataFrame, checks: DataFrame, path: str) -> bool:
    """Writes the table as a new version under ``path`` when the checks hold, then points to it.

    The version is written whole first; only then a pointer file is put in place by a rename.
    A run that dies while writing leaves the last pointer, so the last validated version stays
    the one that :func:`read_validated` gives. Older versions stay until they are cleared.
    """
    import time
    import uuid

    valid = bool(verdict(checks).head()["is_valid"])
    if valid:
        version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        write_table(df, f"{path}/{version}")
        _point(df.sparkSession, path, version)
    return valid


def _fs(spark, path: str):
    jvm = spark._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def _point(spark, path: str, version: str) -> None:
    fs, _ = _fs(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    staged = Path(f"{path}/_staged-{version}")
    out = fs.create(staged, True)
    out.write(bytearray(version.encode()))
    out.close()
    if not fs.rename(staged, Path(f"{path}/_pointer-{version}")):
        raise OSError(f"could not point {path} to {version}")


def read_validated(spark, path: str) -> DataFrame | None:
    """The version that the newest pointer under ``path`` names, or None where none was promoted."""
    fs, name = _fs(spark, path)
    if not fs.exists(name):
        return None
    pointers = sorted(s.getPath().getName() for s in fs.listStatus(name)
                      if s.getPath().getName().startswith("_pointer-"))
    if not pointers:
        return None
    return spark.read.parquet(f"{path}/{pointers[-1][len('_pointer-'):]}")
