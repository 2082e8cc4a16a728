"""Rows from computed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_rows(frame: DataFrame, keep: list, name: str, *values: Column) -> DataFrame:
    """(keep, name): a row per value that is not null.

    The values stand in an exploded array literal. A filter on a computed column would be pushed
    down to the scan with the whole computation in it, and run it twice; a filter on the output of
    an explode stays where it is.
    """
    return frame.select(*keep, F.explode(F.array(*values)).alias(name)).where(
        F.col(name).isNotNull()
    )


CATALOGUE_ROWS = 10_000


def catalogue(frame: DataFrame) -> DataFrame:
    """A table of rules or receipts, marked for broadcast if it was counted and found small. Without a
    mark a join may broadcast the facts instead, whose size is not known to be bounded."""
    return F.broadcast(frame) if frame.limit(CATALOGUE_ROWS + 1).count() <= CATALOGUE_ROWS else frame
