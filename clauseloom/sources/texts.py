"""Regulation text files: lines, paragraphs, raw fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.functions.text import LINE_BREAK
from clauseloom.operators.sentences import parse_paragraphs


def read_paragraphs(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(paragraphs, bad lines) of text files whose lines read `[label] text`."""
    files = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), "value"
    )
    lines = files.select("source", F.posexplode(F.split("value", LINE_BREAK)).alias("pos", "line"))
    parsed = parse_paragraphs(
        lines.select("source", (F.col("pos") + 1).alias("line_no"), "line"),
        "line",
        keep=("source", "line_no"),
    )
    good = parsed.where(F.col("kind") == "paragraph").select("source", "line_no", "label", "text")
    bad = parsed.where(F.col("kind") == "bad").select("source", "line_no", "line")
    return good, bad


def read_fingerprints(spark: SparkSession, paths) -> DataFrame:
    """(source, sha256) of the raw bytes of each file."""
    return (
        spark.read.format("binaryFile")
        .load(paths)
        .select(F.col("path").alias("source"), F.sha2("content", 256).alias("sha256"))
    )
