"""Readers for question and answer dumps in CSV and JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults as D
from .. import schemas as S

POSITION = "_pos"


def _csv_by_header(spark: SparkSession, path, columns, multi_line: bool = True) -> DataFrame:
    """All-text CSV rows found by header name, with their place in the input as ``_pos``.

    A field may hold line breaks; Spark then reads a file as one split, and a large dump must come
    as many files. Without ``multi_line`` large files split. Row numbers grow within a split and paths order the files, so ``_pos``
    stands for file order however the files are packed into tasks.
    """
    raw = spark.read.csv(
        path, header=True, inferSchema=False, multiLine=multi_line,
        quote='"', escape='"', encoding="UTF-8", mode="PERMISSIVE",
    )
    present = set(raw.columns)
    fields = [
        (F.col(f"`{c}`") if c in present else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*fields, place.alias(POSITION))


def read_questions_csv(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    return _csv_by_header(spark, path, S.QUESTION_CSV_COLUMNS, multi_line)


def read_answers_csv(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    return _csv_by_header(spark, path, S.ANSWER_CSV_COLUMNS, multi_line)


def read_questions_csv_split(spark: SparkSession, path) -> DataFrame:
    """Questions from CSV files with line breaks in fields, each file read in many splits."""
    from .split_csv import read_csv_split

    return read_csv_split(spark, path, S.QUESTION_CSV_COLUMNS)


def read_answers_csv_split(spark: SparkSession, path) -> DataFrame:
    """Answers from CSV files with line breaks in fields, each file read in many splits."""
    from .split_csv import read_csv_split

    return read_csv_split(spark, path, S.ANSWER_CSV_COLUMNS)


def read_json_items(
    spark: SparkSession, path, schema: T.StructType, item_depth: int = 1, outside=None,
) -> DataFrame:
    """Items of one JSON array per file, read by split; see ``split_json``."""
    from .split_json import read_json_items as read

    return read(spark, path, schema, item_depth, outside)


def read_json_array(spark: SparkSession, path, schema: T.StructType, lines: bool = False) -> DataFrame:
    """Files that each hold one JSON array of records, read with a given schema.

    A file that is one document is one split. With ``lines`` each line is such an array, and
    large files split.
    """
    return spark.read.schema(schema).json(path, multiLine=not lines)


def landed_questions(spark: SparkSession, path, tags=D.TAGS, lines: bool = False) -> DataFrame:
    """Question items of landed responses with the place each was met in.

    A response is one file, or with ``lines`` one line. Pages come in the order of ``tags``; pages of other or no tag follow in file order.
    """
    pages = spark.read.schema(S.LANDED_QUESTIONS).json(path, multiLine=not lines)
    order = F.array(*[F.lit(t) for t in tags]) if tags else F.array().cast("array<string>")
    rank = F.array_position(order, F.coalesce("tag", F.lit("")))
    page = F.when(rank > 0, rank).otherwise(F.lit(len(tags) + 1).cast("long"))
    items = pages.select(
        page.alias("page"), F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"), F.posexplode("items").alias("item", "record"),
    )
    return items.select("record.*", F.struct("page", "file", "line", "item").alias(POSITION))


def landed_question_documents(spark: SparkSession, path, tags=D.TAGS) -> DataFrame:
    """Question items of landed responses that are each one JSON document in a file, read by split.

    Items are found at depth 2 (the ``items`` array of the response object); the response's tag
    comes from the document without its items. Places order as in ``landed_questions``.
    """
    from .split_json import read_json_items

    item = S.LANDED_QUESTIONS["items"].dataType.elementType
    found = read_json_items(spark, path, item, item_depth=2, outside=F.get_json_object("_outside", "$.tag"))
    order = F.array(*[F.lit(t) for t in tags]) if tags else F.array().cast("array<string>")
    rank = F.array_position(order, F.coalesce("_outside", F.lit("")))
    page = F.when(rank > 0, rank).otherwise(F.lit(len(tags) + 1).cast("long"))
    return found.select(*[c for c in found.columns if c not in ("_pos", "_outside")],
                        F.struct(page.alias("page"), "_pos.file", "_pos.kb", "_pos.kp", "_pos.ka").alias(POSITION))


def landed_answers(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """Answer items of landed responses with the place each was met in."""
    batches = spark.read.schema(S.LANDED_ANSWERS).json(path, multiLine=not lines)
    items = batches.select(
        "batch", F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("line"), F.posexplode("items").alias("item", "record"),
    )
    return items.select("record.*", F.struct("batch", "file", "line", "item").alias(POSITION))


def _exists(open_table):
    """The opened table, or None where nothing is at its place."""
    try:
        table = open_table()
        table.schema
        return table
    except AnalysisException as problem:
        missing = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
        if (problem.getCondition() or "") in missing:
            return None
        raise


def first_available(spark: SparkSession, *candidates: str) -> DataFrame:
    """The first candidate that exists, read lazily: a catalog name or a Parquet path."""
    for name in candidates:
        if "/" in name:
            table = _exists(lambda: spark.read.parquet(name))
        else:
            table = spark.table(name) if spark.catalog.tableExists(name) else None
        if table is not None:
            return table
    raise FileNotFoundError(f"none of these exists: {', '.join(candidates)}")


def optional_json(spark: SparkSession, path, schema: T.StructType) -> DataFrame | None:
    """A JSON Lines report where one was written, else None."""
    return _exists(lambda: spark.read.schema(schema).json(path))
