"""From raw documents to packed training sequences, a written table after each stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qalathe.llm import exact_dedup, ngram_join, packing, quality, suffix_dedup
from qalathe.llm.work import saved


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five words in a row at a similarity of 0.8 or more."""
    return ngram_join.one_of_each_group(docs, n=5, percent=80)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 50 bytes that an earlier document holds."""
    return suffix_dedup.without_repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_passages),
    ("packing", pack),
]

# The classifier is learned, which SQL cannot express. A test runs the stages one by one and holds run()
# to them; the operators of the stages are tested against brute force on their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the given documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
