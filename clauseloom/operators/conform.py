"""Loan files against the vocabulary: what does not conform is reported, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseloom.model import LOAN_VOCABULARY, Vocabulary
from clauseloom.sources.loans import parse_date


def conform(raw: DataFrame, key: str, vocabulary: Vocabulary = LOAN_VOCABULARY) -> DataFrame:
    """(key, field, problem) for raw loans, dates still text. Row-wise: one scan, no join."""
    problems = [
        F.struct(F.lit(name).alias("field"), _problem(name, kind, vocabulary).alias("problem"))
        for name, kind in vocabulary.fields.items()
        if kind in ("date", "enum", "date_list")
    ]
    rows = raw.select(key, F.explode(F.array(*problems)).alias("p"))
    return rows.where(F.col("p.problem").isNotNull()).select(key, "p.*")


def _problem(name: str, kind: str, vocabulary: Vocabulary) -> Column:
    value = F.col(name)
    if kind == "date":
        return F.when(value.isNotNull() & parse_date(value).isNull(), "not a date")
    if kind == "enum":
        return F.when(~value.isin(list(vocabulary.enums[name])), "not a listed value")
    # One pattern over the joined list and one cast of the list, in place of a test per element.
    joined = F.array_join(value, ",", "null")
    shaped = joined.rlike(r"^(?:\d{4}-\d{2}-\d{2}(?:,(?!$)|$))*$")
    real = F.size(F.array_compact(value.try_cast("array<date>"))) == F.size(value)
    return F.when(value.isNull(), "no list").when(~(shaped & real), "not a date")
