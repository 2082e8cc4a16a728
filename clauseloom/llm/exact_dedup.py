"""Exact duplicates of whole texts by a heavy-hitter split, in DataFrame functions only.

1. Digests (SHA-256 of the UTF-8 text; null counts as empty) are written once, without texts.
2. A Misra-Gries summary (the frequent-items sketch of `approx_top_k`: counters that are decreased
   together when they run out) is kept per task, merged in a tree, and names at most `capacity`
   digests. A digest with more than 4 / capacity of all rows is always among them.
3. Named digests are counted exactly; those that occur twice or more are the winners. There are at
   most `capacity` winners, whatever the data, so they are broadcast, and their rows are settled
   in the map task that reads them. Whatever the sketch misses is only slower, never wrong.
4. The rows of all other digests are shuffled by digest; no group of them is large.

Cases: the row with the largest key stays, null keys last; of rows with the same key and text one
stays. Empty and null texts are one group. An empty table gives an empty result. Further columns
are not read by `groups` and kept as they are by `deduplicate`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseloom.llm.shared import written

CAPACITY = 1024
TREE = 64  # summaries are merged in so many groups first


def digest(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def frequent(digests: DataFrame, column: str, capacity: int = CAPACITY) -> DataFrame:
    """(column): at most `capacity` values, all that have more than 4 / capacity of the rows."""
    parts = digests.groupBy((F.spark_partition_id() % TREE).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate({column}, {capacity})").alias("summary")
    )
    # Grouped, as a combination without rows, as in an empty partition, is an error.
    whole = parts.groupBy((F.col("part") >= 0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {capacity})").alias("summary"))
    named = whole.select(
        F.explode(F.expr(f"approx_top_k_estimate(summary, {capacity})")).alias("found")
    )
    return named.select(F.col(f"found.item").alias(column))


def winners(digests: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(digest, keep, size) of the frequent digests, counted exactly; at most `capacity` rows."""
    named = written(frequent(digests, "digest", capacity), "frequent")
    counted = (
        digests.join(F.broadcast(named), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max(F.struct("key", "row")).alias("keep"), F.count("*").alias("size"))
        .where(F.col("size") > 1)
    )
    return written(counted, "winners")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256."""
    digests = written(
        docs.select(
            F.col(key).alias("key"), digest(text).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    split = digests.join(F.broadcast(winners(digests, capacity)), "digest", "left")
    same = Window.partitionBy("digest")
    light = split.where(F.col("size").isNull()).withColumns(
        {
            "keep": F.max(F.struct("key", "row")).over(same),
            "size": F.count("*").over(same),
        }
    )
    both = split.where(F.col("size").isNotNull()).unionByName(light)
    return both.select(
        F.col("key").alias(key),
        F.col("keep.key").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text",
                capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with their columns. Rows of winners go in the map task; the texts
    left are shuffled by digest once."""
    columns = docs.columns
    digests = written(
        docs.select(F.col(key).alias("key"), digest(text).alias("digest"),
                    F.lit(0).alias("row")),
        "digests",
    )
    heavy = winners(digests, capacity).select(
        F.col("digest").alias("__digest"), F.col("keep.key").alias("__keep")
    )
    tagged = docs.withColumn("__digest", digest(text)).join(F.broadcast(heavy), "__digest", "left")
    # A winner's rows all go but those with the key that stays.
    left = tagged.where(F.col("__keep").isNull() | (F.col(key) == F.col("__keep")))
    order = Window.partitionBy("__digest").orderBy(F.desc_nulls_last(key))
    return left.withColumn("__nth", F.row_number().over(order)).where("__nth = 1").select(*columns)
