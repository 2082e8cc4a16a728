"""Regulation text: paragraphs, sentences, stated numbers, duplicate ids, normal form.

Explodes of computed arrays are outer ones with the null row dropped after: for a plain explode
Catalyst infers a `size > 0` filter below it and would run the text patterns twice.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clauseloom.functions import text as tx


def parse_paragraphs(lines: DataFrame, line: str, keep: Iterable[str] = ()) -> DataFrame:
    """Lines with a `kind`: blank, note, paragraph (with label and text) or bad. A bad line is a
    finding, not the end of the job."""
    col = F.col(line)
    label = F.regexp_extract(col, tx.PARAGRAPH, 1)
    kind = (
        F.when(tx.is_blank(col), "blank")
        .when(col.startswith("#"), "note")
        .when(label != "", "paragraph")
        .otherwise("bad")
    )
    ok = F.col("kind") == "paragraph"
    return (
        lines.select(*keep, col.alias(line), kind.alias("kind"))
        .withColumn("label", F.when(ok, F.regexp_extract(F.col(line), tx.PARAGRAPH, 1)))
        .withColumn("text", F.when(ok, F.regexp_extract(F.col(line), tx.PARAGRAPH, 2)))
    )


def split_sentences(
    paragraphs: DataFrame, label: str, text: str, keep: Iterable[str] = ()
) -> DataFrame:
    """(keep, id, n, text, label, heading): the first sentence of a paragraph carries its label
    and heading, the next ones `label.s2`, `label.s3`."""
    parts = paragraphs.select(
        *keep,
        F.col(label).alias("label"),
        tx.heading(F.col(text)).alias("heading"),
        F.posexplode_outer(tx.sentences(F.col(text))).alias("pos", "text"),
    ).where(F.col("pos").isNotNull())
    n = F.col("pos") + 1
    return parts.select(
        *keep,
        F.when(n == 1, F.col("label"))
        .otherwise(F.concat("label", F.lit(".s"), n.cast("string")))
        .alias("id"),
        n.alias("n"),
        "text",
        "label",
        F.when(n == 1, F.col("heading")).alias("heading"),
    )


def stated_numbers(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, value): each number a text states, once per text."""
    found = F.explode_outer(tx.stated_numbers(F.col(text))).alias("value")
    return texts.select(key, found).where(F.col("value").isNotNull())


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys used more than once. Counts combine before the shuffle, so a hot key is cheap."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_uses")).where(F.col("n_uses") > 1)


def _not_nfc():
    """The test as a local function, which travels to the executors by value: they need not have
    this package installed."""

    def not_nfc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: not unicodedata.is_normalized("NFC", t))

    return F.pandas_udf(not_nfc, T.BooleanType())


def nfc_violations(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Keys of texts that are not in Unicode NFC. Spark has no normaliser, so the test runs in
    Arrow batches, and only on texts with a character that can compose at all."""
    return (
        texts.select(key, text)
        .where(F.col(text).rlike(tx.MAY_COMPOSE))
        .where(_not_nfc()(F.col(text)))
        .select(key)
    )


def fingerprints(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sha256) of the UTF-8 bytes of each text."""
    return texts.select(key, F.sha2(F.encode(F.col(text), "UTF-8"), 256).alias("sha256"))
