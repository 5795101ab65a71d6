"""One-row-per-key lookups and the joins against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A key with at least this many rows is spread over several tasks.
HOT_ROWS = 1_000_000
FAN_OUT = 64


def _one_per_key(df: DataFrame, keys, position: str, order) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys and c != position]
    by_key = Window.partitionBy(*keys).orderBy(order(position))
    return df.withColumn("_nth", F.row_number().over(by_key)).where("_nth = 1").select(*keys, *rest)


def last_per_key(df: DataFrame, keys, position: str = "_pos") -> DataFrame:
    """The last row of each key. The window is limited to its first row on the map side already,
    so a task sends one row of a key, and none ever holds all of them."""
    return _one_per_key(df, keys, position, F.desc)


def first_per_key(df: DataFrame, keys, position: str = "_pos") -> DataFrame:
    """The first row of each key; see :func:`last_per_key`."""
    return _one_per_key(df, keys, position, F.asc)


def unique_lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str,
    hot_rows: int = HOT_ROWS, fan_out: int = FAN_OUT,
) -> DataFrame:
    """Inner join of ``rows`` with a ``lookup`` that has one row per ``key``.

    The lookup comes out of an aggregation, which keeps the engine's own skew splitting from
    working on the join. So rows of a hot key are dealt over ``fan_out`` tasks by the
    partition they were read in, and the one lookup row of that key is repeated to meet them.
    The hot-key list holds at most count(rows) / hot_rows keys, which bounds its broadcast;
    where it is empty the adaptive planner drops both helper joins.
    """
    hot = (
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= hot_rows)
        .select(F.col(key), F.lit(fan_out).alias("_fan"))
    )
    hot = F.broadcast(hot)
    spread = (
        rows.withColumn("_part", F.spark_partition_id()).join(hot, key, "left")
        .withColumn("_salt", F.when(F.col("_fan").isNotNull(), F.pmod("_part", "_fan")).otherwise(0))
        .drop("_fan", "_part")
    )
    repeated = (
        lookup.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1)))
        .drop("_fan")
    )
    return spread.join(repeated, [key, "_salt"], "inner").drop("_salt")
