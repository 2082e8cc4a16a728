"""Groups that would outgrow a task: families of texts that are alike but below the limit."""

import random
import tracemalloc

import numpy as np
import pytest

from clauseloom.llm import jaccard, quality
from tests.llm.test_operators import brute_components, docs_of


def family(rng, rows):
    """Texts that share a passage; some are copies with few words changed, sizes differ."""
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=60)
    texts = []
    for _ in range(rows):
        own = rng.choices(words, k=rng.choice([8, 10, 12, 60]))
        texts.append(" ".join(passage + own))
        if rng.random() < 0.2:
            own[-1] = "z"
            texts.append(" ".join(passage + own))
    return texts


@pytest.mark.parametrize("block, group", [(7, 30), (50, 1000)])
def test_a_family_below_the_limit_is_dealt_in_blocks(spark, monkeypatch, block, group):
    monkeypatch.setattr(jaccard, "PER_BLOCK", block)
    monkeypatch.setattr(jaccard, "PER_GROUP", group)
    whole, largest = jaccard.cells, []

    def cells(rows, percent):
        largest.append(max((r["count"] for r in rows.groupBy("run").count().collect()), default=0))
        return whole(rows, percent)

    monkeypatch.setattr(jaccard, "cells", cells)
    texts = family(random.Random(11), 150)
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs_of(spark, texts)).collect()}
    assert got == want
    assert largest[0] > 2 * block


def test_every_pair_that_sizes_allow_is_in_one_unit(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PER_BLOCK", 5)
    rng = random.Random(12)
    rows = [(run, key, key, rng.randint(1, 60)) for run in (1, 2) for key in range(80)]
    rows += [(3, key, key, 10) for key in range(4)]
    frame = spark.createDataFrame(rows, "run long, key long, root long, n long")
    size = {(run, key): n for run, key, _, n in rows}
    units = {}
    for r in jaccard.cells(frame, 75).collect():
        units.setdefault((r.run, r.unit), ([], []))[r.side].append(r.key)
    pairs = []
    for (run, _), (left, right) in units.items():
        assert len(left) + len(right) < 40
        couples = [(a, b) for a in left for b in right] if right else [
            (a, b) for a in left for b in left if a < b
        ]
        pairs += [(run, *sorted(c)) for c in couples]
    assert len(pairs) == len(set(pairs))
    allowed = {
        (run, a, b) for run in (1, 2, 3) for r, a in size if r == run for q, b in size
        if q == run and a < b and 100 * min(size[run, a], size[run, b]) >= 75 * max(size[run, a], size[run, b])
    }
    assert allowed <= set(pairs)


def test_quality_learns_the_same_of_repeated_keys(spark):
    rows = [(i % 40, f"{'good plain words here. ' * (i % 7 + 1) if i % 2 else 'X1 # ' * (i % 9 + 1)}{i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id int, quality int")
    models = [
        quality.train(spark.createDataFrame(order, "doc_id int, text string").repartition(n), labels, rows=30)
        for order, n in ((rows, 2), (rows[::-1], 7))
    ]
    texts = spark.createDataFrame(rows, "doc_id int, text string")
    first, second = (sorted(quality.predict(texts, m, keep=["doc_id"]).collect()) for m in models)
    assert first == second


def test_a_task_hands_on_a_forest_of_alike_nodes_and_then_all_pairs(spark):
    """One run of 40 nodes that may all link: as many pairs as join them, not all of them."""
    rows = [(5, k, k) for k in range(40)]
    placed = spark.createDataFrame(rows, "run long, key long, root long")
    sketch = bytes([7] * 8)
    sets = spark.createDataFrame([(k, 30, bytearray(sketch)) for k in range(40)], "key long, n long, sketch binary")
    few = jaccard.cross_pairs(placed, sets, 75, every=False).collect()
    assert len(few) == 39 and all(r.more for r in few) and {x for r in few for x in (r.a, r.b)} == set(range(40))
    every = jaccard.cross_pairs(placed, sets, 75).collect()
    assert len(every) == 40 * 39 // 2 and not any(r.more for r in every)


def test_pairs_checked_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """Near copies, most of which are not linked with the node that leads their runs."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=150)
    texts = []
    for i in range(80):
        own = list(base)
        for j in rng.sample(range(150), 2 if i else 7):
            own[j] = rng.choice(words)
        texts.append(" ".join(own))
    seen, check = [], jaccard.checked

    def checked(pairs, *rest):
        seen.append(pairs.count())
        return check(pairs, *rest)

    monkeypatch.setattr(jaccard, "checked", checked)
    monkeypatch.setattr(jaccard, "star_pairs", lambda placed, turn: placed.select(
        placed.key.alias("a"), placed.key.alias("b")).limit(0))
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs_of(spark, texts)).collect()}
    assert got == want
    assert sum(seen) < 5 * len(texts)


def test_the_codes_of_a_bucket_need_few_arrays():
    """Runs of codes, with less than three arrays of 64 bits a code at once."""
    codes = np.random.default_rng(3).integers(0, 1 << 32, 500_000).astype(np.uint32)
    codes[::1000] = 77
    tracemalloc.start()
    place, run = jaccard.runs_of(codes)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * 8 * len(codes)
    found = {}
    for p, r in zip(place.tolist(), run.tolist()):
        found.setdefault(r, set()).add(p)
    want = {}
    for p, c in enumerate(codes.tolist()):
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
