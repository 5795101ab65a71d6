"""Small tables: constant rows, and one-row tables set beside larger ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few constant rows as a plan the optimizer folds; meant for table metadata."""
    structs = [
        F.struct(*[
            F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)
        ])
        for row in rows
    ]
    kind = T.ArrayType(schema)
    table = F.array(*structs) if structs else F.array()
    return spark.range(1).select(F.inline(table.cast(kind)))


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The table with the columns of a one-row table (a global aggregate) added to every row.

    A scalar subquery: the row is computed once and reaches the tasks as a constant, no join.
    """
    packed = one_row.select(F.struct("*").alias("_one")).scalar()
    return df.withColumn("_one", packed).select(
        *df.columns, *[F.col("_one").getField(c).alias(c) for c in one_row.columns])
