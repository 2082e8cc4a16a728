"""What the operators share on Spark's side: tables written to the shared folder, text columns."""

from __future__ import annotations

import ctypes
from functools import wraps
from inspect import isgeneratorfunction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the folder named by spark.checkpoint.dir.

    It cuts the lineage: what is read later survives the loss of any executor.
    """
    spark = frame.sparkSession
    path = shared_path(spark, f"llm-{name}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, of: int):
    """crc32 of the key as text, modulo `of`: how held-out rows are told."""
    return F.crc32(F.col(key).cast("string")) % of


def release() -> None:
    """Hands memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def lean(run):
    """The function of Arrow data, with its memory handed back when it is done. Python workers live on
    between tasks and stages, beside whatever the executor then does."""
    if isgeneratorfunction(run):
        @wraps(run)
        def released(batches):
            yield from run(batches)
            release()
    else:
        @wraps(run)
        def released(group):
            found = run(group)
            release()
            return found
    return released


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
