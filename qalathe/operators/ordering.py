"""Sorting, frequencies and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import unique_lookup_join


def best_first(df: DataFrame, score: str = "quality_score", position: str = "question_id") -> DataFrame:
    """Whole table by falling score, ties by ``position``, a key or a column of the input order.

    The position makes the sort keys distinct, so equal scores spread over the range
    partitions instead of meeting in one.
    """
    return df.orderBy(F.desc(score), position)


def value_counts(df: DataFrame, column: str, as_value: str = "value") -> DataFrame:
    """How often each value occurs; an array counts each of its elements, null nothing."""
    field = df.schema[column].dataType
    one = F.explode(column) if field.typeName() == "array" else F.col(column)
    return (
        df.select(one.alias(as_value)).where(F.col(as_value).isNotNull())
        .groupBy(as_value).agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, equal counts by value."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(k)


def duplicate_summary(df: DataFrame, keys) -> DataFrame:
    """One row: rows, distinct keys, and copies beyond the first of each key; nulls are equal.

    Counting per key first keeps the shuffle to the key and one number. A count(distinct) next
    to other aggregates would drag all their buffers along for every key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicate_flags(df: DataFrame, keys, position: str) -> DataFrame:
    """Every row with ``is_duplicate``: true for all but the first row of its key.

    The first position per key is aggregated and joined back, so no task has to sort all
    copies of one key. ``position`` must be distinct within a key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    keyed = df.withColumn("_key", F.struct(*keys))
    first = keyed.groupBy("_key").agg(F.min(position).alias("_first"))
    return (
        unique_lookup_join(keyed, first, "_key")
        .withColumn("is_duplicate", F.col(position) > F.col("_first"))
        .drop("_key", "_first")
    )
