"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.llm.shared import written

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(key, root) for every key in links (a, b): root is the smallest key of its component.

    In a large-star round every key hangs its larger neighbours on the least of its
    neighbourhood, in a small-star round the smaller ones. Both keep components as they are; the
    number of rounds grows with the logarithm of the longest path. Each round is a table in the
    shared folder. Nothing but whether it is done comes to the driver. No group is collected: the least of a
    neighbourhood is a partial aggregate, joined back.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "star",
    )
    for _ in range(ROUNDS):
        # Done when every key hangs on one other, which hangs on none.
        ends = edges.select(F.col("a").alias("key"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
            edges.select("b", F.lit(0), F.lit(1))
        )
        open_ = ends.groupBy("key").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        if open_.where("hangs > 1 or (hangs > 0 and holds > 0)").isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            hung.select("a", F.col("m").alias("b"))
        )
        edges = written(small.where("a <> b").distinct(), "star")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    tops = edges.select(F.col("b").alias("key")).distinct().join(
        roots.select(F.col("a").alias("key")), "key", "left_anti"
    )
    return written(
        roots.select(F.col("a").alias("key"), "root").union(tops.select("key", F.col("key").alias("root"))),
        "roots",
    )
