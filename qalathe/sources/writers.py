"""Writers. Stages hand over Parquet; JSON, JSON Lines and CSV are for the outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.StructType, T.MapType)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are written too, so that keys stay stable."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Report and table sink; Spark writes JSON as lines, in as many files as partitions."""
    write_jsonl(df, path)


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text; CSV has no nested values."""
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, _NESTED)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes, and white space kept as it is."""
    flat_for_csv(df).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
