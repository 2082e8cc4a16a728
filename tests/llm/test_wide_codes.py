"""Exact search at production width."""

import collections
import random

from clauseloom.llm import hamming
from tests.llm.test_operators import brute_top_k


def test_wide_codes_in_clusters(spark):
    rng = random.Random(21)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = []
    for i in range(300):
        v = list(centres[i % 5])
        for j in rng.sample(range(64), rng.choice([0, 2, 9, 25])):
            v[j] = -v[j]
        rows.append((i, v))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    answer = hamming.top_k(frame, frame.where("vec_id % 20 = 0"), k=10)
    for r in answer.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.distance))
    assert dict(found) == brute_top_k(rows, range(0, 300, 20), 10, 64)
