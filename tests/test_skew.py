"""One key holds a third of all rows: results are whole, and the hot side is split or reduced."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from clauseloom.operators import checks, gates, quotes, sentences

ROWS = 60_000


@contextmanager
def settings(spark, **conf):
    """Sizes at which a test-sized table counts as skewed, and no broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
        **conf,
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark):
    """Receipts of which a third cite one sentence of one source."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 997))
    return spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("r"), "id").alias("rule_id"),
        key.alias("sentence_id"),
        F.when(F.col("id") % 1000 == 0, "absent").otherwise("three days").alias("quote"),
        key.alias("source"),
        F.when(F.col("id") % 3000 == 0, "old").otherwise("new").alias("source_sha256"),
    )


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_sentence_is_split(spark):
    text = spark.range(997).select(F.concat(F.lit("s"), "id").alias("sentence_id"), F.lit("within three days").alias("text"))
    text = text.unionByName(spark.createDataFrame([("hot", "within three days")], text.schema))
    with settings(spark):
        found = gates.quote_missing(hot(spark), text)
        subjects = {r.subject for r in found.collect()}
        assert "skew=true" in final_plan(found)
    assert subjects == {f"r{i}" for i in range(0, ROWS, 1000)}


def test_hot_source_meets_its_pairs_only(spark):
    sources = spark.range(997).select(F.concat(F.lit("s"), "id").alias("source"), F.lit("new").alias("sha256"))
    sources = sources.unionByName(spark.createDataFrame([("hot", "new")], sources.schema))
    with settings(spark):
        found = gates.source_drift(hot(spark), sources)
        assert {r.subject for r in found.collect()} == {f"r{i}" for i in range(0, ROWS, 3000)}


def test_hot_rule_combines_before_the_shuffle(spark):
    tests = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("rule_id"),
        F.when(F.col("id") % 2 == 0, "pass").otherwise("fail").alias("expectation"),
    )
    rules = tests.select("rule_id", F.lit("rule").alias("kind")).distinct()
    gaps = checks.coverage_gaps(tests, rules)
    assert {r.rule_id for r in gaps.collect()} == {f"r{i}" for i in range(50)}
    assert "partial_max" in final_plan(gaps)


def test_hot_edges_and_ids(spark):
    nodes = spark.createDataFrame([(1, "out", 2, 2)], "pack int, node_id string, n_inputs int, n_outputs int")
    nodes = nodes.unionByName(
        spark.range(2000).select(F.lit(1).alias("pack"), F.concat(F.lit("n"), "id").alias("node_id"), F.lit(2), F.lit(2))
        .toDF("pack", "node_id", "n_inputs", "n_outputs")
    )
    target = F.when(F.col("id") % 3 == 0, "out").otherwise(F.concat(F.lit("n"), F.col("id") % 2001))
    edges = spark.range(0, 20_000, 1, 4).select(
        F.lit(1).alias("pack"), F.concat(F.lit("e"), "id").alias("edge_id"), F.lit("n0").alias("source_id"), target.alias("target_id")
    )
    found = {r.subject for r in gates.graph_integrity(nodes, edges).collect()}
    assert found == {f"1/e{i}" for i in range(20_000) if i % 3 and i % 2001 == 2000}
    ids = spark.range(0, ROWS, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"))
    assert [tuple(r) for r in sentences.duplicates(ids, "id").collect()] == [("hot", ROWS // 3)]


def test_copies_of_one_text(spark):
    """A third of the texts are copies that hold every quote: all pairs that hold are found."""
    texts = spark.range(0, 3000, 1, 4).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "it is due no later than three business days before closing, or so")
        .otherwise(F.concat(F.lit("other words and more words "), "id")).alias("text"),
    )
    wanted = [(1, "later than three business days before"), (2, "no later than"), (3, "or"), (4, "nothing of it at all here")]
    q = spark.createDataFrame(wanted, "item_id int, text string")
    with settings(spark):
        found = quotes.quote_search(q, texts, "item_id", "doc_id").groupBy("item_id").count().collect()
    assert {r.item_id: r["count"] for r in found} == {1: 1000, 2: 1000, 3: 3000}
