"""Overlapping slices, their metrics, bias verdicts and suggested remedies.

Every slice of every dimension lives in one membership table, so one grouping measures all of
them: the table is read once however many slices there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults as D
from ..functions import python_round
from ..functions.numeric import exact_means
from ..operators import beside, column_quantiles, exact_quantiles

SCALAR_DIMENSIONS = ("question_type", "complexity")
ARRAY_DIMENSIONS = {"tags": "tag_", "error_signatures": "error_", "infra_components": "infra_"}
SLICE_KEYS = ["dimension", "value"]


def slice_name(arrays=None) -> Column:
    """Display name of a slice: the value, with the prefix of its dimension if it has one."""
    arrays = ARRAY_DIMENSIONS if arrays is None else arrays
    prefix = F.lit("")
    for dimension, text in arrays.items():
        prefix = F.when(F.col("dimension") == dimension, F.lit(text)).otherwise(prefix)
    return F.concat(prefix, F.col("value"))


def dimension_order(scalars=SCALAR_DIMENSIONS, arrays=None) -> Column:
    arrays = ARRAY_DIMENSIONS if arrays is None else arrays
    names = [*scalars, *arrays]
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col("dimension"))


def memberships(df: DataFrame, scalars=SCALAR_DIMENSIONS, arrays=None, keep=()) -> DataFrame:
    """One row per (row, slice it belongs to), with the columns in ``keep``.

    An array counts each distinct element once; nulls belong to no slice. Columns the table
    lacks are passed over.
    """
    arrays = ARRAY_DIMENSIONS if arrays is None else arrays
    families = [(c, F.array(F.col(c).cast("string"))) for c in scalars if c in df.columns]
    families += [(c, F.array_distinct(c)) for c in arrays if c in df.columns]
    if not families:
        raise ValueError("the table has none of the slice dimensions")
    dims = F.array(*[
        F.struct(F.lit(c).alias("dimension"), values.alias("values")) for c, values in families])
    return (
        df.select(*keep, F.inline(dims))
        .select(*keep, "dimension", F.explode("values").alias("value"))
        .where(F.col("value").isNotNull())
    )


def slices_of(df: DataFrame, column: str, min_samples: int | None = None) -> DataFrame:
    """Values of one scalar or array column with at least ``min_samples`` rows."""
    least = D.SLICE_MIN_SAMPLES if min_samples is None else min_samples
    is_array = df.schema[column].dataType.typeName() == "array"
    rows = memberships(df, () if is_array else (column,), {column: ""} if is_array else {})
    counts = rows.groupBy(*SLICE_KEYS).agg(F.count(F.lit(1)).alias("count"))
    return counts.where(F.col("count") >= least)


def _lengths(df: DataFrame) -> DataFrame:
    """Texts give way to their lengths before the rows are multiplied by their slices."""
    have = set(df.columns)
    out = df
    for text, name in (("question_body", "question_length"), ("answer_body", "answer_length")):
        out = out.withColumn(
            name, F.length(text).cast("double") if text in have else F.lit(None).cast("double"))
    for c in ("quality_score", "answer_score"):
        if c not in have:
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out


_MEASURED = ("quality_score", "answer_score", "question_length", "answer_length")


def _moments() -> list[Column]:
    """Count and standard deviations; means come from :func:`exact_means`."""
    out = [F.count(F.lit(1)).alias("count")]
    for c in _MEASURED:
        out.append(F.stddev_samp(F.col(c).cast("double")).alias(f"{c}_std"))
    return out


def _ordered(df: DataFrame, first: list[str]) -> DataFrame:
    moments = [name for c in _MEASURED for name in (f"{c}_mean", f"{c}_std")]
    rest = [c for c in df.columns if c not in (*first, "count", *moments)]
    return df.select(*first, "count", *moments, *rest)


def overall_metrics(df: DataFrame, median: bool = True) -> DataFrame:
    """One row of the metrics over the whole table."""
    narrow = _lengths(df).select(*_MEASURED)
    row = _ordered(beside(narrow.agg(*_moments()), exact_means(narrow, [], list(_MEASURED))), []).withColumn(
        "proportion", F.when(F.col("count") > 0, F.lit(1.0)))
    if median:
        mid = column_quantiles(narrow, ["quality_score"], {"m": 0.5})
        row = beside(row, mid.agg(F.max("m").alias("quality_score_median")))
    return row


def slice_metrics(
    df: DataFrame, min_samples: int | None = None, scalars=SCALAR_DIMENSIONS, arrays=None,
    median: bool = True, approximate: bool = False,
) -> DataFrame:
    """Metrics of every slice with enough rows.

    A popular slice is no burden: all aggregates combine before the shuffle, and the median
    comes from :func:`exact_quantiles`.
    """
    least = D.SLICE_MIN_SAMPLES if min_samples is None else min_samples
    member = memberships(_lengths(df), scalars, arrays, keep=_MEASURED)
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    counted = member.groupBy(*SLICE_KEYS).agg(*_moments()).where(F.col("count") >= least)
    means = exact_means(member, SLICE_KEYS, list(_MEASURED))
    same = [counted[k].eqNullSafe(means[k]) for k in SLICE_KEYS]
    measured = _ordered(counted.join(means, same, "left").select(
        *[counted[k] for k in SLICE_KEYS], *[counted[c] for c in counted.columns if c not in SLICE_KEYS],
        *[means[c] for c in means.columns if c not in SLICE_KEYS]), SLICE_KEYS)
    out = (
        beside(measured, total)
        .withColumn("proportion", F.col("count") / F.col("_total")).drop("_total")
        .withColumn("slice", slice_name(arrays))
    )
    if median:
        mid = exact_quantiles(
            member, SLICE_KEYS, "quality_score", {"quality_score_median": 0.5}, approximate, few_groups=False)
        out = out.join(mid, SLICE_KEYS, "left")
    return out


def slice_shares(
    df: DataFrame, column: str = "complexity", min_samples: int | None = None,
    scalars=SCALAR_DIMENSIONS, arrays=None,
) -> DataFrame:
    """Share of each value of ``column`` within each slice, as (dimension, value, class, share)."""
    least = D.SLICE_MIN_SAMPLES if min_samples is None else min_samples
    member = memberships(df.withColumn("_class", F.col(column)), scalars, arrays, keep=("_class",))
    counts = member.groupBy(*SLICE_KEYS, "_class").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*SLICE_KEYS).agg(
        F.sum("n").alias("_rows"), F.sum(F.when(F.col("_class").isNotNull(), F.col("n"))).alias("_known"))
    return (
        counts.where(F.col("_class").isNotNull()).join(totals.where(F.col("_rows") >= least), SLICE_KEYS)
        .select(*SLICE_KEYS, F.col("_class").alias("class"), "n",
                (F.col("n") / F.col("_known")).alias("share"))
    )


# --- verdict --------------------------------------------------------------------------

def _difference_factor(name, slice_mean, overall_mean, limit, up, down) -> Column:
    """Factor struct where the means differ by more than ``limit``, else null. The limit is tested
    on the exact ratio, severity later on the rounded one."""
    ratio = F.abs(slice_mean - overall_mean) / overall_mean
    flagged = (overall_mean > 0) & (F.try_divide(F.abs(slice_mean - overall_mean), overall_mean) > limit)
    return F.when(flagged, F.struct(
        F.lit(name).alias("factor"),
        python_round(slice_mean, 2).alias("slice_value"),
        python_round(overall_mean, 2).alias("overall_value"),
        python_round(ratio, 3).alias("difference_ratio"),
        F.when(slice_mean > overall_mean, up).otherwise(down).alias("direction"),
        F.lit(None).cast("double").alias("slice_proportion"),
        F.lit(None).cast("long").alias("slice_count"),
        F.lit(None).cast("string").alias("message"),
    ))


def bias_verdicts(
    metrics: DataFrame, overall: DataFrame, threshold: float | None = None,
    length_threshold: float = D.LENGTH_BIAS_THRESHOLD,
    min_proportion: float = D.UNDERREP_PROPORTION, min_count: int = D.UNDERREP_COUNT,
) -> DataFrame:
    """Each slice with its bias factors, whether it is biased, and how badly."""
    limit = D.BIAS_THRESHOLD if threshold is None else threshold
    reference = overall.select(
        F.col("quality_score_mean").alias("_quality"), F.col("answer_length_mean").alias("_length"))
    quality = _difference_factor(
        "quality_score", F.col("quality_score_mean"), F.col("_quality"), limit, "higher", "lower")
    length = _difference_factor(
        "answer_length", F.col("answer_length_mean"), F.col("_length"), length_threshold,
        "longer", "shorter")
    rare = F.when(
        (F.col("proportion") < min_proportion) & (F.col("count") < min_count),
        F.struct(
            F.lit("underrepresentation").alias("factor"),
            *[F.lit(None).cast("double").alias(n)
              for n in ("slice_value", "overall_value", "difference_ratio")],
            F.lit(None).cast("string").alias("direction"),
            python_round("proportion", 4).alias("slice_proportion"),
            F.col("count").alias("slice_count"),
            F.lit("Slice severely underrepresented").alias("message"),
        ))
    worst = F.greatest(
        F.coalesce(F.col("_f1.difference_ratio"), F.lit(0.0)),
        F.coalesce(F.col("_f2.difference_ratio"), F.lit(0.0)))
    factors = F.size("bias_factors")
    return (
        beside(metrics, reference)
        .withColumns({"_f1": quality, "_f2": length, "_f3": rare})
        .withColumn("bias_factors", F.array_compact(F.array("_f1", "_f2", "_f3")))
        .withColumn("is_biased", factors > 0)
        .withColumn(
            "severity",
            F.when(factors == 0, "none")
            .when((worst > 0.75) | (factors >= 3), "high")
            .when((worst > 0.5) | (factors >= 2), "medium").otherwise("low"))
        .drop("_quality", "_length", "_f1", "_f2", "_f3")
    )


def biased_slices(verdicts: DataFrame) -> DataFrame:
    return verdicts.where("is_biased")


def bias_summary(verdicts: DataFrame) -> DataFrame:
    """One row: slices, biased slices, their rate, and counts per severity."""
    return verdicts.agg(
        F.count(F.lit(1)).alias("total_slices"),
        F.count_if("is_biased").alias("biased_slices"),
        F.coalesce(F.avg(F.col("is_biased").cast("int")), F.lit(0.0)).alias("bias_rate"),
        *[F.count_if(F.col("severity") == s).alias(f"{s}_severity_count")
          for s in ("high", "medium", "low")],
    )


# Fixed texts: issues and remedies as reports name them.

def suggestions(verdicts: DataFrame, high_priority_count: int = 50) -> DataFrame:
    """One row per remedy. Slices of higher quality need none."""
    factor, name = F.col("_f.factor"), F.col("slice")
    rare = factor == "underrepresentation"
    poor = (factor == "quality_score") & (F.col("_f.direction") == "lower")
    long_or_short = factor == "answer_length"
    return (
        verdicts.where("is_biased")
        .select("slice", *SLICE_KEYS, "count", F.posexplode("bias_factors").alias("_place", "_f"))
        .where(rare | poor | long_or_short)
        .select(
            "slice", *SLICE_KEYS, "count", F.col("_place").alias("factor_order"),
            F.when(rare, "Underrepresentation").when(poor, "Lower quality examples")
            .otherwise(F.concat(F.lit("Answers are "), F.col("_f.direction"), F.lit(" than average")))
            .alias("issue"),
            F.when(rare, "data_augmentation").when(poor, "quality_filtering")
            .otherwise("length_normalization").alias("strategy"),
            F.when(rare, F.concat(
                F.lit("Consider augmenting data for '"), name,
                F.lit("' through: (1) Collecting more examples, (2) Synthetic data generation, "
                      "(3) Oversampling existing examples")))
            .when(poor, F.concat(
                F.lit("Slice '"), name,
                F.lit("' has lower quality scores. Consider: (1) Setting higher quality thresholds for "
                      "this slice, (2) Manual review and curation, (3) Weighted sampling during training")))
            .otherwise("Consider normalizing answer lengths or using length-aware training strategies")
            .alias("description"),
            F.when(rare, F.when(F.col("count") < high_priority_count, "high").otherwise("medium"))
            .when(poor, "medium").otherwise("low").alias("priority"),
        )
    )


def bias_report(df: DataFrame, min_samples: int | None = None, threshold: float | None = None):
    """The tables of one bias analysis: overall, verdicts (with metrics), suggestions, summary."""
    overall = overall_metrics(df)
    verdicts = bias_verdicts(slice_metrics(df, min_samples), overall, threshold)
    return {
        "overall": overall, "slices": verdicts, "suggestions": suggestions(verdicts),
        "summary": bias_summary(verdicts),
    }


def bias_run_metrics(verdicts: DataFrame) -> DataFrame:
    """One row: the summary and the number of suggestions."""
    n = suggestions(verdicts).agg(F.count(F.lit(1)).alias("mitigation_suggestions_count"))
    return beside(bias_summary(verdicts), n)
