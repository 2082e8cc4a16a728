"""Verdicts for loan files as they arrive.

Rules look at one loan at a time, so the stream is stateless: no watermark, no state store, and
each micro-batch runs the very plan of the batch form. Exactly once comes from the file sink and
the checkpoint, both in a folder the cluster shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clauseloom.model import Pack
from clauseloom.operators.rules import evaluate
from clauseloom.sources.loans import CORRUPT, raw_schema, rejected, typed, with_corrupt


def loan_stream(spark: SparkSession, folder: str, key: str = "loan_id") -> DataFrame:
    """JSON-lines loan files of a folder, as a stream of typed loans."""
    raw = _raw_stream(spark, folder, key)
    return typed(raw.where(F.col(CORRUPT).isNull()), keep=(key,))


def rejected_stream(spark: SparkSession, folder: str, key: str = "loan_id") -> DataFrame:
    """(check, subject, detail): the lines of the same files that are no loans, for a sink of their own."""
    return rejected(_raw_stream(spark, folder, key), "file")


def _raw_stream(spark: SparkSession, folder: str, key: str) -> DataFrame:
    schema = T.StructType([T.StructField(key, T.StringType()), *raw_schema().fields])
    lines = spark.readStream.text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    return with_corrupt(lines.where(F.trim("value") != ""), schema, keep=("file",))


def append_findings(findings: DataFrame, out: str):
    """Starts the query that appends the findings there are now under `out`, then ends."""
    return (
        findings.writeStream.format("parquet")
        .option("path", f"{out}/findings")
        .option("checkpointLocation", f"{out}/findings-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def table_stream(spark: SparkSession, path: str, to_loans: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A parquet table read as a stream of its files, turned into loans."""
    schema = spark.read.parquet(path).schema
    return to_loans(spark.readStream.schema(schema).parquet(path))


def stream_verdicts(loans: DataFrame, pack: Pack, out: str, key: str = "loan_id"):
    """Starts the query that appends verdicts under `out` for all loans there are now, then ends."""
    return (
        evaluate(loans, pack, key)
        .writeStream.format("parquet")
        .option("path", f"{out}/verdicts")
        .option("checkpointLocation", f"{out}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
