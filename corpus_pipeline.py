"""The corpus pipeline: language, exact copies, near copies, mixture, pieces.

Each stage takes (spark, docs, sf_dir) and returns the rows the next one works on. All but the last
return the columns of `documents`. run() writes each stage to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clauseloom.llm import exact_dedup, jaccard, langid, mixing, pieces
from clauseloom.llm.shared import remainder, table, written

REPETITION = 1.5  # passes over a source at most


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language. Rejected: no letters, or no text. Learns from labelled
    rows that are not held out."""
    model = langid.train(docs.where(remainder("doc_id", 3) != 1))
    columns = docs.columns
    found = langid.predict(docs, model, label="__language", score="__score")
    return found.where("__language <> 'und'").select(*columns)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.75 of five-word shingles the first stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture has it, once at least."""
    return mixing.mix(docs, repetition=REPETITION)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the pieces of the text."""
    return pieces.with_ids(docs.select("doc_id", "lang", "source", "text"), pieces.load(),
                           drop_text=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("exact dedup", remove_exact_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# A conditional random field cannot be written in SQL; see tests/llm for the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
