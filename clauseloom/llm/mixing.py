"""Mixing sources to target weights by temperature, in DataFrame functions only.

The share of a source is its part of all tokens (words). Shares are raised to an exponent between
1 (as they are) and 0 (all alike) and normalised. The exponent is bisected: the smallest one that
keeps every source at `repetition` passes or fewer, or the largest one whose weights reach
`entropy` (a fraction of the largest entropy possible); with both, repetition is the limit that
holds. Without a budget the mixture is as long as it must be for no source to get less than
one pass, so that no document is left out.

Weights become documents as budgeted block permutations: documents are dealt to blocks by hash, an
order of blocks and of documents within a block is drawn by hash, and a source runs through whole
passes and then as many documents of one more pass as its budget pays for. Only the block
in which the budget ends is looked at by document; the outcome is one cut (block order, document
order) per source, which every map task applies to its own rows. A source is never gathered in
one task, and texts are not shuffled.

Cases: a null source is a source. Documents without words cost nothing and appear once. Null keys
hash as empty text. Rows with the same key share their fate. An empty table gives an empty result.
The number of sources is that of a catalogue: their weights are one array in the bisection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseloom.llm.shared import WORD, written

STEPS = 50  # halvings of the exponent
BLOCK_ROWS = 1000  # documents per block, on average over all sources
BROADCAST_SOURCES = 20_000  # rows of three short columns; beyond, a plain join


def _drawn(key, seed: int):
    """32 hex digits drawn for a document; the first 7 deal it to a block."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{seed}")))


def _dealt(drawn, blocks):
    return F.conv(F.substr(drawn, F.lit(1), F.lit(7)), 16, 10).cast("long") % blocks


def _block_order(block, seed: int):
    return F.md5(F.concat(block.cast("string"), F.lit(f"#{seed}")))


def weights(sources: DataFrame, repetition: float | None, entropy: float | None,
            budget: int | None) -> DataFrame:
    """Adds `exponent`, `weight` and `target` (tokens) to (source, tokens)."""
    some = F.filter(F.collect_list("tokens"), lambda t: t > 0)
    total = sources.agg(some.alias("sizes")).withColumns(
        {
            # From 0 to 1 by size against the largest, so that powers stay in range.
            "largest": F.array_max("sizes"),
            "smallest": F.array_min("sizes"),
        }
    )
    powers = "transform(sizes, t -> pow(t / double(largest), {a}))"
    sums = "aggregate(" + powers + ", 0D, (x, y) -> x + y)"
    # entropy = log(sum p) - sum(p log p) / sum p, and log p = a * log(t / largest)
    spread = ("log(" + sums + ") - aggregate(transform(sizes, t -> {a} * log(t / double(largest))"
              " * pow(t / double(largest), {a})), 0D, (x, y) -> x + y) / " + sums)
    passes = (f"{budget}D / " + sums + " * pow(smallest / double(largest), {a}) / smallest"
              if budget is not None else "pow(smallest / double(largest), {a} - 1)")

    def bisected(fits: str):
        """The end of the interval at which `fits` holds, from (0, 1); it holds at 1."""
        half = fits.format(a="((s.lo + s.hi) / 2)")
        return (
            "aggregate(sequence(1, {n}), named_struct('lo', 0D, 'hi', 1D), (s, i) -> if({half}, "
            "named_struct('lo', s.lo, 'hi', (s.lo + s.hi) / 2), "
            "named_struct('lo', (s.lo + s.hi) / 2, 'hi', s.hi))).hi"
        ).format(n=STEPS, half=half)

    found = []
    if repetition is not None:
        found.append(bisected("(" + passes + f") <= {repetition}D"))
    if entropy is not None:
        # Entropy falls as the exponent grows: the largest that still reaches it.
        found.append(bisected("(" + spread + f") < {entropy}D * log(double(size(sizes)))"))
    text = {0: "1D", 1: found[0] if found else ""}.get(len(found)) or f"greatest({', '.join(found)})"
    solved = total.withColumn("exponent", F.expr(text))
    whole = solved.withColumn("powers", F.expr(sums.format(a="exponent")))
    one = whole.select("exponent", "largest", "powers").first()
    exponent, largest, powers = (float(v) if v is not None else 1.0 for v in one)
    share = F.pow(F.col("tokens") / F.lit(largest), F.lit(exponent)) / F.lit(powers)
    # Without a budget the largest source, which gets the fewest passes, gets one.
    length = float(budget) if budget is not None else largest * powers
    each = sources.withColumn("weight", F.when(F.col("tokens") > 0, share).otherwise(0.0))
    return each.select(
        "source", "tokens", F.lit(exponent).alias("exponent"), "weight",
        F.round(F.col("weight") * F.lit(length)).cast("long").alias("target"),
    )


def plan(docs: DataFrame, key: str, source: str, text: str, repetition: float | None,
         entropy: float | None, budget: int | None, seed: int, block_rows: int):
    """(documents with tokens, block and draw; per source weight, passes and cut; blocks)."""
    counted = written(
        docs.select(
            F.col(key).alias("key"), F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
            .alias("n_tokens"),
            _drawn(F.col(key), seed).alias("drawn"),
        ),
        "counted",
    )
    blocks = max(1, -(-counted.count() // block_rows))
    dealt = counted.withColumn("block", _dealt(F.col("drawn"), blocks))
    by_block = written(
        dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks"
    )
    sources = by_block.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    weighted = written(weights(sources, repetition, entropy, budget), "weights").withColumns(
        {
            "passes": F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens")))
            .otherwise(1),
            "rest": F.when(F.col("tokens") > 0, F.col("target") % F.col("tokens")).otherwise(0),
        }
    )
    return dealt, weighted, by_block, blocks


def cuts(dealt: DataFrame, weighted: DataFrame, by_block: DataFrame, seed: int) -> DataFrame:
    """The sources with `cut_block` and `cut_drawn`: of one more pass, documents before the cut."""
    same = F.col("b.source").eqNullSafe(F.col("w.source"))
    ahead = Window.partitionBy("source").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    ordered = by_block.withColumn("nth", _block_order(F.col("block"), seed)).withColumn(
        "before", F.coalesce(F.sum("tokens").over(ahead), F.lit(0))
    )
    last = (
        ordered.alias("b").join(weighted.alias("w"), same)
        .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("b.tokens")))
        .select("b.source", "block", "nth", (F.col("rest") - F.col("before")).alias("left"))
    )
    within = Window.partitionBy("source", "block").orderBy("drawn").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    same_block = F.col("d.source").eqNullSafe(F.col("l.source")) & (
        F.col("d.block") == F.col("l.block")
    )
    inside = (
        dealt.alias("d").join(last.alias("l"), same_block)
        .select("d.source", "d.block", "drawn", "n_tokens", "nth", "left")
        .groupBy("source", "block", "drawn", "nth", "left").agg(F.sum("n_tokens").alias("n"))
        .withColumn("start", F.sum("n").over(within) - F.col("n"))
    )
    cut = inside.groupBy("source").agg(
        F.first("nth").alias("cut_block"),
        F.min(F.when(F.col("start") >= F.col("left"), F.col("drawn"))).alias("cut_drawn"),
    )
    return weighted.alias("w").join(
        cut.alias("b"), same, "left"
    ).select("w.*", "cut_block", F.coalesce("cut_drawn", F.lit("g")).alias("cut_drawn"))


def with_copies(rows: DataFrame, chosen: DataFrame, n_sources: int, source: str, seed: int):
    """Rows with `drawn`, `block` and their source's cut, and `copies`."""
    named = chosen.select(
        F.col("source").alias("__source"), F.col("weight").alias("weight"), "exponent", "passes",
        "rest", "cut_block", "cut_drawn",
    )
    if n_sources <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    nth = _block_order(F.col("block"), seed)
    more = (nth < F.col("cut_block")) | (
        (nth == F.col("cut_block")) & (F.col("drawn") < F.col("cut_drawn"))
    )
    extra = F.when((F.col("rest") > 0) & F.coalesce(more, F.lit(False)), 1).otherwise(0)
    return rows.join(named, F.col(source).eqNullSafe(F.col("__source"))).withColumn(
        "copies", (F.col("passes") + extra).cast("long")
    )


def mixture(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
            repetition: float | None = 1.5, entropy: float | None = None,
            budget: int | None = None, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: key, source, n_tokens, weight of its source, block, copies."""
    dealt, weighted, by_block, _ = plan(
        docs, key, source, text, repetition, entropy, budget, seed, block_rows
    )
    chosen = written(cuts(dealt, weighted, by_block, seed), "cuts")
    mixed = with_copies(dealt, chosen, chosen.count(), "source", seed)
    return mixed.select(
        F.col("key").alias(key), F.col("source").alias(source), "n_tokens", "weight", "exponent",
        "block", "copies",
    )


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        repetition: float | None = 1.5, entropy: float | None = None, budget: int | None = None,
        seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The documents of the mixture, each as often as it occurs, with the columns of `docs`."""
    columns = docs.columns
    dealt, weighted, by_block, blocks = plan(
        docs, key, source, text, repetition, entropy, budget, seed, block_rows
    )
    chosen = written(cuts(dealt, weighted, by_block, seed), "cuts")
    tagged = docs.select(
        F.struct(*columns).alias("row"), F.col(source).alias("source"),
        _drawn(F.col(key), seed).alias("drawn"),
    ).withColumn("block", _dealt(F.col("drawn"), blocks))
    mixed = with_copies(tagged, chosen, chosen.count(), "source", seed)
    return mixed.select(
        "row", F.explode(F.expr("if(copies > 0, sequence(1L, copies), array())")).alias("nth")
    ).select("row.*")
