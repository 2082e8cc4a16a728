"""Verdicts at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_verdicts(verdicts: DataFrame, path: str, mode: str = "error") -> str:
    """Parquet, one folder per rule, so a question about one rule reads its folder only.

    Rows are not shuffled for it: each task writes what it has, one file per rule. The number of
    rules is small; the number of loans is not.
    """
    verdicts.write.mode(mode).partitionBy("rule_id").parquet(path)
    return path
