"""Loan files: one nested object per loan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clauseloom.model import LOAN_VOCABULARY, Vocabulary

DATE_FORMAT = "yyyy-MM-dd"


def raw_schema(vocabulary: Vocabulary = LOAN_VOCABULARY) -> T.StructType:
    """The vocabulary's nested schema with dates as text, as files carry them."""
    return _dates_as_text(vocabulary.schema())


def _dates_as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _dates_as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_dates_as_text(kind.elementType))
    return T.StringType() if isinstance(kind, T.DateType) else kind


def typed(raw: DataFrame, vocabulary: Vocabulary = LOAN_VOCABULARY, keep=()) -> DataFrame:
    """Text dates parsed once; a text that is no date becomes null and is reported by `conform`."""
    return raw.select(*keep, *[_typed(F.col(f.name), f.dataType).alias(f.name)
                               for f in vocabulary.schema()])


def _typed(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_typed(col[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.transform(col, parse_date)
    return parse_date(col) if isinstance(kind, T.DateType) else col


def parse_date(text: Column) -> Column:
    """Exactly YYYY-MM-DD and a real day, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, DATE_FORMAT))


CORRUPT = "_corrupt"


def read_loans(
    spark: SparkSession,
    path: str,
    vocabulary: Vocabulary = LOAN_VOCABULARY,
    one_per_file: bool = True,
) -> DataFrame:
    """JSON loan files as typed rows: one object per file, or one per line for bulk files, which
    Spark can then split. What does not parse is no loan; `rejected_loans` has it."""
    raw = _raw_loans(spark, path, vocabulary, one_per_file)
    return typed(raw.where(F.col(CORRUPT).isNull()), vocabulary, keep=("file",))


def rejected_loans(
    spark: SparkSession,
    path: str,
    vocabulary: Vocabulary = LOAN_VOCABULARY,
    one_per_file: bool = True,
) -> DataFrame:
    """(check, subject, detail): what `read_loans` of the same files leaves out, as findings; the subject
    is the file, the detail the text as it stands there."""
    raw = _raw_loans(spark, path, vocabulary, one_per_file)
    return rejected(raw, "file")


def rejected(raw: DataFrame, name: str) -> DataFrame:
    """The findings of rows of `with_corrupt` that did not parse."""
    return raw.where(F.col(CORRUPT).isNotNull()).select(
        F.lit("unreadable").alias("check"), F.col(name).cast("string").alias("subject"), F.col(CORRUPT).alias("detail")
    )


def with_corrupt(texts: DataFrame, schema: T.StructType, body: str = "value", keep=()) -> DataFrame:
    """The fields of the object in each text, and the text itself in CORRUPT where it is none. Texts are
    parsed here, not by the JSON source, which refuses plans that ask for what did not parse alone."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(body), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    found = texts.select(*keep, F.col(body), parsed.alias("raw"))
    corrupt = F.when(F.col("raw").isNull(), F.col(body)).otherwise(F.col(f"raw.{CORRUPT}"))
    return found.select(*keep, *[F.col(f"raw.{f.name}") for f in schema], corrupt.alias(CORRUPT))


def _raw_loans(spark: SparkSession, path: str, vocabulary: Vocabulary, one_per_file: bool) -> DataFrame:
    texts = spark.read.text(path, wholetext=one_per_file).select("value", F.col("_metadata.file_path").alias("file"))
    if not one_per_file:
        texts = texts.where(F.trim("value") != "")
    return with_corrupt(texts, raw_schema(vocabulary), keep=("file",))


def parse_loans(frame: DataFrame, body: str, keep=(), vocabulary: Vocabulary = LOAN_VOCABULARY) -> DataFrame:
    """The same from a text column holding one JSON object per row, as a message queue delivers."""
    raw = frame.select(*keep, F.from_json(F.col(body), raw_schema(vocabulary)).alias("raw"))
    return typed(raw.select(*keep, "raw.*"), vocabulary, keep=keep)
