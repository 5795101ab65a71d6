"""Work tables in the folder that all executors share, and memory of Python workers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path


def saved(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """The table, written to the shared folder and read back.

    Cuts the lineage so that it survives a lost executor, fixes values that depend on the
    order of partitions, and lets the adaptive planner see the true size of what follows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes work tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for root in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slots(spark: SparkSession) -> int:
    """Number of partitions for a shuffle that the adaptive planner may not merge."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


# --- memory of Python workers -------------------------------------------------------------

_T = TypeVar("_T")


@functools.lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """The C library's call that returns freed memory, or nothing where it has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Returns the memory this worker has freed to the system.

    Allocators keep it otherwise, and workers live on from stage to stage beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lean(parts: Iterator[_T]) -> Iterator[_T]:
    """``parts``; what was freed while one of them was worked on is given back before the next is made."""
    for part in parts:
        yield part
        del part
        give_back()
