"""Lines that many documents share: exploded, hashed, counted per document, dropped, reassembled.

Defined cases. A null or empty text is one empty line. Every row is a document, so a repeated
row counts again. Keys shorter than ``min_chars`` code points are never dropped; with the default
of 1 an empty line stays. If all lines go, the text is empty. Row order and other columns stay as
they are; columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty
table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import saved

BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _lines(docs: DataFrame, text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """MD5 of each line key found in at least ``min_docs`` documents, with their number.

    Keys are made distinct within the document before the shuffle, and counting combines on the
    map side, so a line that every document holds costs one row per map task.
    """
    keys = F.filter(F.transform(_lines(docs, text), line_key), lambda k: F.length(k) >= min_chars)
    return (
        docs.select(F.explode(F.array_distinct(F.transform(keys, F.md5))).alias("line_hash"))
        .groupBy("line_hash").agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` without the lines whose key at least ``min_docs`` documents hold.

    Only line hashes and positions meet the table of common lines; its true size is known by
    then, so it is broadcast where it is small, and otherwise the adaptive planner splits the
    rows of a hot line. Texts are shuffled once, to meet the positions that they lose. A document
    is known by its id and a 128-bit hash of its text, so ids may be null or repeated.
    """
    common = saved(common_lines(docs, min_docs, min_chars, text), "common-lines").select("line_hash")
    base = (
        docs.drop("n_lines", "n_dropped")
        .withColumn("__k1", F.xxhash64(doc_id, text))
        .withColumn("__k2", F.xxhash64(F.lit(1), F.col(doc_id), F.col(text)))
        .withColumn("__lines", _lines(docs, text))
    )
    dropped = (
        base.select("__k1", "__k2", F.posexplode("__lines").alias("__pos", "__line"))
        .select("__k1", "__k2", "__pos", line_key(F.col("__line")).alias("__key"))
        .where(F.length("__key") >= min_chars)
        .select("__k1", "__k2", "__pos", F.md5("__key").alias("line_hash"))
        .join(common, "line_hash")
        .groupBy("__k1", "__k2").agg(F.collect_set("__pos").alias("__dropped"))
    )
    n = F.size("__lines")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), n - 1), F.col("__dropped")), lambda i: F.get("__lines", i))
    return (
        base.join(dropped, ["__k1", "__k2"], "left")
        .withColumn(text, F.when(F.col("__dropped").isNull(), F.coalesce(F.col(text), F.lit("")))
                    .otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", n.cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("__dropped"), F.lit(0)).cast("long"))
        .drop("__k1", "__k2", "__lines", "__dropped")
    )
