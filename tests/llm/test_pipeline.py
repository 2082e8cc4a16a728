"""The registered queries and the pipeline on the given tables."""

import collections
import zlib

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from clauseloom.llm import jaccard, langid, mixing, pieces
from clauseloom.llm.queries import ORACLES, QUERIES
from clauseloom.llm.shared import table
from clauseloom.plans.corpus import TABLES
from tests.llm.test_operators import brute_components
from tools.compare import compare


def test_all_operators_and_the_pipeline_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_check(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    assert ": ok," in compare(spark, con, name, data)


def test_pipeline_is_its_parts(spark, data):
    docs = table(spark, data, "documents").toPandas()
    model = langid.train(table(spark, data, "documents").where("crc32(cast(doc_id as string)) % 3 <> 1"))
    spoken = {r.doc_id for r in langid.predict(table(spark, data, "documents"), model).collect() if r.lang_pred != "und"}
    left = docs[docs.doc_id.isin(spoken)]
    left = left.sort_values("doc_id").drop_duplicates("text", keep="last").reset_index(drop=True)
    found = brute_components(list(left.text))
    left = left[[found[i][1] == i for i in range(len(left))]]
    frame = spark.createDataFrame(left)
    copies = {r.doc_id: r.copies for r in mixing.mixture(frame, repetition=corpus_pipeline.REPETITION).collect()}
    rows = corpus_pipeline.run(spark, data).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(copies)
    decoder, by_id = pieces.Decoder(pieces.load()), dict(zip(docs.doc_id, docs.text))
    for r in rows[:50]:
        import numpy as np

        assert decoder.decode(np.array(r.ids), np.array([0, len(r.ids)]))[0].decode() == by_id[r.doc_id]


def test_held_out_rows_are_told_by_crc32(spark, data):
    rows = queries()["op8_language_id"](spark, data).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert jaccard.bounds(75)[:6].tolist() == [1, 2, 3, 5, 7, 10]
