"""Reports: the readback of a pack, and the explanation of a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.functions import names
from clauseloom.model import LOAN_VOCABULARY, Vocabulary
from clauseloom.operators.checks import disagreements
from clauseloom.operators.rows import catalogue


def readback(
    sentences: DataFrame, states: DataFrame, receipts: DataFrame, links: DataFrame
) -> DataFrame:
    """(source, seq, sentence_id, part, item, line): a pack as report lines.

    Every line is a row with its place in the report, so nothing is collected per sentence: one
    that thousands of rules cite just has more rows. `sentences` has (source, seq, sentence_id,
    heading, text).
    """
    title = F.when(
        F.col("heading").isNotNull(),
        F.concat(F.col("sentence_id"), F.lit(" "), F.regexp_replace("heading", "[.]+$", "")),
    ).otherwise(F.col("sentence_id"))
    place = sentences.select("source", "seq", "sentence_id")
    state = F.col("state")
    own = sentences.join(states.select("sentence_id", "state"), "sentence_id", "left")
    lines = own.select(
        "source",
        "seq",
        "sentence_id",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("part"), F.lit("").alias("item"), title.alias("line")),
                F.struct(F.lit(2).alias("part"), F.lit("").alias("item"), F.concat(F.lit("> "), "text").alias("line")),
                F.struct(F.lit(3).alias("part"), F.lit("").alias("item"), F.concat(F.lit("State: "), state, F.lit(".")).alias("line")),
                F.struct(
                    F.lit(6).alias("part"), F.lit("").alias("item"),
                    F.when(state == "QUESTION", "Open question.").alias("line"),
                ),
            )
        ).alias("l"),
    ).select("source", "seq", "sentence_id", "l.*").where(F.col("line").isNotNull())
    rules = place.join(receipts.select("sentence_id", "rule_id", "quote"), "sentence_id").select(
        "source",
        "seq",
        "sentence_id",
        F.lit(4).alias("part"),
        F.col("rule_id").alias("item"),
        F.concat(F.lit("Rule "), "rule_id", F.lit(", quote: \""), "quote", F.lit('"')).alias("line"),
    )
    cited = place.join(links, "sentence_id").select(
        "source",
        "seq",
        "sentence_id",
        F.lit(5).alias("part"),
        F.col("target").alias("item"),
        F.concat(
            F.lit("Link ("), "kind", F.lit(") to "), "target", F.lit(", cited as \""), "cited_as", F.lit('"')
        ).alias("line"),
    )
    return lines.unionByName(rules).unionByName(cited)


def rule_sentences(rows: DataFrame, vocabulary: Vocabulary = LOAN_VOCABULARY) -> DataFrame:
    """(row_id, line): decision rows as sentences, fields by their labels, the rest as written."""
    line = names.rule_sentence(
        names.labelled(F.col("i1"), vocabulary.labels),
        names.labelled(F.col("i2"), vocabulary.labels),
        F.col("result"),
    )
    return rows.select("row_id", line.alias("line"))


def in_report_order(lines: DataFrame) -> DataFrame:
    """Report lines sorted for writing: a range sort over the cluster, not one task."""
    return lines.orderBy("source", "seq", "part", "item")


def readback_stale(committed: DataFrame, fresh: DataFrame) -> DataFrame:
    """Lines that only the committed or only the fresh report has."""
    side = F.when(F.col("side") == "one", "committed").otherwise("fresh")
    return disagreements(committed, fresh.select(*committed.columns)).withColumn("side", side)


def explain(verdicts: DataFrame, receipts: DataFrame, sentences: DataFrame, key: str = "loan_id") -> DataFrame:
    """Verdicts with the quote and the sentence behind them.

    Receipts meet their sentences first; that table is of the size of the catalogue, and the
    verdicts meet it once, where it is.
    """
    basis = receipts.select("rule_id", "sentence_id", "quote").join(
        sentences.select("sentence_id", F.col("text").alias("sentence")), "sentence_id"
    )
    return verdicts.join(catalogue(basis), "rule_id").select(key, "rule_id", "result", "sentence_id", "quote", "sentence")
