"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (positive or not), cut into m segments of about log2(rows)
bits, each with an index: segment value to codes. Two codes at distance d agree in some segment
up to d / m bits. Round r looks up, in every segment, the values at exactly r bits from the
query's. After it every code within m * (r + 1) - 1 bits has been met, so a query is finished
as soon as its k-th verified distance is no larger; only the others go on to the next radius.
At the full radius all codes have been met, so every answer is exact.

Equal codes are one entry of the index with its k + 1 smallest ids, so a vector that is
repeated over and over costs no more than one. Queries with equal codes are answered once, for k + 1
rows; a query then drops itself. Each meeting of two codes counts in the first round and segment
that brings it about, which both sides can tell, so nothing is removed twice. Each round's best are a table
in the shared folder.

Cases: a null vector is not searched for and never found; a null or missing element counts as not
positive. Rows with the same id and code are one. Ties go to the smaller id. Fewer than k other
rows: all of them. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseloom.llm.shared import written


def segments_of(vector: str, bits: int, size: int):
    """The code of a vector as an array of segments of `size` bits."""
    count = -(-bits // size)
    parts = [
        f"aggregate(sequence({j * size}, {min(bits, (j + 1) * size) - 1}), 0, (acc, i) -> acc * 2 + "
        f"if(coalesce(get({vector}, i), 0) > 0, 1, 0))"
        for j in range(count)
    ]
    return F.expr(f"array({', '.join(parts)})")


def masks(size: int, radius: int) -> list[int]:
    """All values of `size` bits of which `radius` are set."""
    return [sum(1 << b for b in c) for c in itertools.combinations(range(size), radius)]


def _distance(a: str, b: str):
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, d) -> s + d)")


def _first_meeting(a: str, b: str, count: int):
    """radius * count + segment of the first round and segment in which two codes meet."""
    return F.expr(
        f"array_min(transform(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), "
        f"(d, j) -> d * {count} + j))"
    )


def _best(rows: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id",
          vector: str = "embedding", bits: int | None = None, size: int | None = None) -> DataFrame:
    """(query_id, rank, key, distance): the k nearest rows of each query row, itself left out."""
    schema = vectors.select(
        F.col(key).alias("query_id"), F.lit(0).cast("long").alias("rank"), F.col(key),
        F.lit(0).cast("long").alias("distance"),
    ).schema
    rows, longest = vectors.where(F.col(vector).isNotNull()).agg(
        F.count("*"), F.max(F.size(vector))
    ).first()
    if not rows or not longest:
        return vectors.sparkSession.createDataFrame([], schema)
    bits = bits or longest
    size = size or max(4, min(16, bits, round(math.log2(rows + 1))))
    count, most = -(-bits // size), k + 1

    def coded(frame: DataFrame) -> DataFrame:
        return frame.where(F.col(vector).isNotNull()).select(
            F.col(key).alias("id"), segments_of(vector, bits, size).alias("code")
        ).distinct()

    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = written(
        coded(vectors).withColumn("nth", nth).where(F.col("nth") <= most), "code-entries"
    )
    index = written(
        entries.where("nth = 1").select("code", F.posexplode("code").alias("segment", "value")),
        "code-index",
    )
    asked = written(coded(queries), "queries")
    pending = asked.select(F.col("code").alias("query")).distinct()
    enough = min(most, entries.select("id").count())
    best = None
    for radius in range(size + 1):
        flips = F.array(*(F.lit(m) for m in masks(size, radius)))
        probes = (
            pending.select("query", F.posexplode("query").alias("segment", "whole"))
            .select("query", "segment", "whole", F.explode(flips).alias("flip"))
            .select("query", "segment", F.col("whole").bitwiseXOR(F.col("flip")).alias("value"))
        )
        met = (
            probes.join(index.hint("merge"), ["segment", "value"])
            .where(_first_meeting("query", "code", count) == radius * count + F.col("segment"))
            .select("query", "code", _distance("query", "code").alias("distance"))
        )
        # A code gives one row at least: codes beyond the k + 1 nearest cannot matter.
        nearest = Window.partitionBy("query").orderBy("distance")
        close = met.withColumn("place", F.rank().over(nearest)).where(F.col("place") <= most)
        found = close.join(entries.select("code", "id").hint("merge"), "code").select("query", "distance", "id")
        if best is not None:
            found = found.unionByName(best.select("query", "distance", "id"))
        best = written(_best(found, most), f"best-{radius}")
        covered = count * (radius + 1) - 1
        settled = best.where((F.col("nth") == enough) & (F.col("distance") <= covered)).select("query")
        pending = written(pending.join(settled.hint("merge"), "query", "left_anti"), "pending")
        if radius == size or pending.isEmpty():
            break
    answers = asked.join(best.withColumnRenamed("id", "other").hint("merge"), asked["code"] == best["query"])
    answers = answers.where(~F.col("id").eqNullSafe(F.col("other")))
    order = Window.partitionBy("id").orderBy("distance", "other")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), F.col("rank").cast("long").alias("rank"),
        F.col("other").alias(key), F.col("distance").cast("long").alias("distance"),
    )
