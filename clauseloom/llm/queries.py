"""The registered queries of this package: name -> function(spark, folder)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.llm import (
    exact_dedup, fim, hamming, html_text, jaccard, langid, lm, mixing, packing, pieces, pii, quality, spelling,
)
from clauseloom.llm.shared import remainder, table
from clauseloom.llm.sql import ORACLES


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(remainder("doc_id", 3) != 1))
    marked = docs.select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    found = langid.predict(marked, model, keep=["doc_id", "held_out"], score="score")
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op1_hamming_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest rows, by sign bits, of every vector whose id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return hamming.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=10)


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document, and which of them stays."""
    return exact_dedup.groups(table(spark, folder, "documents"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """The log10 probability of every document, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    return lm.score(docs, remainder("doc_id", 7) == 2)


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.extract(table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document under links of 0.75 and more of five-word shingles."""
    return jaccard.join(table(spark, folder, "documents"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page, without anything around it."""
    pages = table(spark, folder, "pages")
    return html_text.extract(pages, html_text.train(pages), keep=["page_id", "url"])


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often every document occurs in a mixture with at most one and a half passes."""
    return mixing.mixture(table(spark, folder, "documents")).select(
        "doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"),
        F.round("exponent", 6).alias("exponent"), "block", "copies",
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learned from the labels that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels.where(remainder("doc_id", 3) != 1))
    marked = docs.select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    return quality.predict(marked, model, keep=["doc_id", "held_out"])


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every document, their score, and whether decoding gives the text back."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pieces.with_ids(
        docs, pieces.load(), score="score", trip="round_trip", drop_text=True
    )
    return found.withColumn("n_pieces", F.size("ids").cast("long"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of binary lengths up to 2048, none of them padded."""
    model = packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, folder, "documents")
    return packing.pack(docs, model, with_ids=False, digest="ids_crc32")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The frequent words of all documents, their near words and the form each is a variant of."""
    counted = spelling.words(table(spark, folder, "documents"))
    return spelling.forms(counted).select("word", "form", "root", "n", "n_near", "form_n")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document transformed and restored, as digests."""
    done = fim.transform(table(spark, folder, "documents").select("doc_id", "text"))
    done = done.withColumn("output_sha256", F.sha2("output", 256)).drop("text")
    return fim.restore(done).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_hamming_top_k": op1_hamming_top_k,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_pii": op4_pii,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_html_extraction": op6_html_extraction,
    "op7_source_mixing": op7_source_mixing,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}

__all__ = ["ORACLES", "QUERIES"]
