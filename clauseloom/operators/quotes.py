"""Which texts contain which quotes, character for character, without comparing all pairs.

A text that contains a quote contains the quote's inner words (all but the first and last, which
the text may continue) as whole words in a row. So a quote is anchored at one run of its inner
words, texts offer their runs, and an equi-join on the hash of a run gives the candidates. Each
candidate is then verified on the whole text. Only hashes reach the join; the texts are read again
for the few candidates.

Quotes with too few inner words for a run are anchored at their longest inner word, and those
without any at their first characters, so no quote is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 4
LEAD = 3
_WORD = r"[\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def _runs(words: str, size: int) -> Column:
    """Every run of `size` words of an array column, joined by a blank."""
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(
        starts,
        lambda i: F.concat_ws(" ", *[F.get(words, i + d) for d in range(size)]),
    )


def _longest(runs: Column) -> Column:
    """The longest run: long words are rare words, and any run of the quote will do."""
    return F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]


def anchors(quotes: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class, anchor): each quote's class and the hash it is found by.

    Class 0 is anchored at a run of words, 1 at a word, 2 to 4 at its first one to three
    characters. The class is part of the hash.
    """
    inner = F.expr("slice(words, 2, greatest(size(words) - 2, 0))")
    cut = quotes.select(key, F.col(text).alias("q"), _words(F.col(text)).alias("words"))
    lead = F.substring("q", 1, LEAD)
    chosen = cut.withColumn("inner", inner).select(
        key,
        F.when(F.size("inner") >= RUN, F.struct(F.lit(0).alias("class"), _longest(_runs("inner", RUN)).alias("a")))
        .when(F.size("inner") >= 1, F.struct(F.lit(1).alias("class"), _longest(F.col("inner")).alias("a")))
        .otherwise(F.struct((1 + F.length(lead)).alias("class"), lead.alias("a")))
        .alias("c"),
    )
    return chosen.select(key, "c.class", F.xxhash64("c.class", "c.a").alias("anchor"))


def _offered(kind: int) -> Column:
    """What a text (columns words, t) offers to quotes of one class."""
    if kind == 0:
        return _runs("words", RUN)
    if kind == 1:
        return F.col("words")
    size = kind - 1
    starts = F.sequence(F.lit(1), F.greatest(F.length("t") - size + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.substring(F.col("t"), i, F.lit(size)))


def _hashed(offered: Column, kind: int) -> Column:
    return F.transform(offered, lambda r: F.xxhash64(F.lit(kind), r))


def offers(texts: DataFrame, key: str, text: str, kinds: list[int]) -> DataFrame:
    """(key, anchor): what a text offers to quotes of the given classes, each once per text."""
    cut = texts.select(key, F.col(text).alias("t"), _words(F.col(text)).alias("words"))
    hashes = [_hashed(_offered(kind), kind) for kind in kinds]
    rows = cut.select(key, F.explode_outer(F.array_distinct(F.concat(*hashes))).alias("anchor"))
    return rows.where(F.col("anchor").isNotNull())


def quote_search(
    quotes: DataFrame, texts: DataFrame, quote_key: str, text_key: str, text: str = "text"
) -> DataFrame:
    """(quote_key, text_key) for every quote and every text that contains it. Empty quotes are
    in every text and are left out.

    The classes that occur (five at most) are looked up first, so that texts, read once for
    their offers, do not offer single characters when every quote has words.
    """
    quotes = quotes.where(F.length(text) > 0)
    anchored = anchors(quotes, quote_key, text)
    kinds = sorted(r[0] for r in anchored.select("class").distinct().collect())
    if not kinds:
        kinds = [0]
    found = offers(texts, text_key, text, kinds).join(anchored, "anchor").select(quote_key, text_key)
    worded = found.join(quotes.select(quote_key, F.col(text).alias("quote")), quote_key)
    whole = texts.select(text_key, F.col(text).alias("whole"))
    return whole.join(worded, text_key).where(F.contains("whole", "quote")).select(quote_key, text_key)
