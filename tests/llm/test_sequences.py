"""Packing and fill-in-the-middle against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clauseloom.llm import fim, packing
from clauseloom.llm.queries import QUERIES
from clauseloom.llm.words import text_bytes
from tests.llm.test_operators import ODD, docs_of

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ODD + [
    "It's 'S a b c\u0085d\x1ce <|endoftext|>x<|startoftext|>", "ΑΣ ΣΑΣ İ ﬁ é é ́x",
    "漢字 かな 🙂🙂 z", "x" * 5000, "word " * 9000, "Ÿ\tÀ\nß  ,,, ---",
]


# --- op11 -----------------------------------------------------------------------------------------

def whole_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, ids_of, most=2048):
    """Every id in one piece, pieces of binary length, sequences numbered without gaps by length."""
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(ids_of)
    for key, found in by_doc.items():
        ids, at = ids_of[key], 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0)
            assert r.length <= most and r.length & (r.length - 1) == 0 and 1 << r.bucket == r.length
            assert r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
        short = [r.length for r in found if r.length < most]
        assert len(short) == len(set(short))
    order = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in order] == list(range(len(rows)))
    assert [r.length for r in order] == sorted((r.length for r in rows), reverse=True)


def test_packing_query_is_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas()
    rows = QUERIES["op11_packing"](spark, data).collect()
    check_packing(rows, dict(zip(docs.doc_id, whole_ids(docs.text))))


def test_packing_of_awkward_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 2)
    docs = docs_of(spark, HARD).withColumn("start", F.lit("x")).withColumn("ids", F.lit(1)).repartition(5)
    rows = packing.pack(docs, packing.read_tokenizer(PATH), digest="ids_crc32").collect()
    check_packing(rows, dict(enumerate(whole_ids(HARD))))
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in rows)


def test_packing_repeated_and_null_keys(spark):
    docs = spark.createDataFrame([(7, "a b c"), (7, "a b c"), (None, "d"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs, packing.read_tokenizer(PATH), digest="ids_crc32", with_ids=False).collect()
    assert sorted((r.doc_id or 0, r.length, r.doc_tokens) for r in rows) == [(0, 1, 1), (0, 2, 2), (7, 4, 4), (7, 4, 4)]
    assert sorted(r.sequence_id for r in rows) == [0, 1, 2, 3]
    none = packing.pack(docs.limit(0), packing.read_tokenizer(PATH))
    assert none.count() == 0 and packing.batches(none).count() == 0


def test_packing_other_lengths_and_memory(spark, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 1000)
    docs = docs_of(spark, ["a " * n for n in range(40)])
    rows = packing.pack(docs, packing.read_tokenizer(PATH), length=8, digest="ids_crc32").collect()
    check_packing(rows, dict(enumerate(whole_ids(["a " * n for n in range(40)]))), 8)
    with pytest.raises(ValueError):
        packing.pack(docs, packing.read_tokenizer(PATH), length=100)


def test_batches_hold_one_length(spark):
    docs = docs_of(spark, ["a " * (n % 50) for n in range(120)])
    packed = packing.batches(packing.pack(docs, packing.read_tokenizer(PATH), length=16), tokens=64)
    sizes = collections.Counter((r.bucket, r.batch) for r in packed.collect())
    last = {}
    for b, n in sizes:
        last[b] = max(last.get(b, 0), n)
    for (b, n), held in sizes.items():
        assert held == 64 >> b if n < last[b] else held <= 64 >> b


def test_cuts_are_binary_digits():
    sizes = np.array([1, 2, 3, 2047, 2048, 2049, 4096, 5000])
    row, start, length = packing.cuts(sizes, 2048)
    for i, n in enumerate(sizes):
        of = length[row == i]
        assert of.sum() == n and list(start[row == i]) == [0, *np.cumsum(of)[:-1]]
        assert list(of) == [2048] * (n // 2048) + [1 << b for b in range(10, -1, -1) if n % 2048 >> b & 1]


# --- op13 -----------------------------------------------------------------------------------------

def brute_fim(key, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_fim_is_brute_force(spark):
    rng = random.Random(5)
    letters = list("ab <>PSM\nß漢🙂é")
    texts = HARD + ["<P", "a<S>b", "<<P><S", "<M>"] + ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(400)]
    docs = docs_of(spark, texts).withColumn("output", F.lit("x")).withColumn("n", F.lit("x")).unionAll(
        docs_of(spark, ["ÿa", "b"]).withColumn("doc_id", F.lit(None).cast("long"))
        .withColumn("output", F.lit("x")).withColumn("n", F.lit("x")))
    done = fim.restore(fim.transform(docs), cuts=("p", "m")).withColumnRenamed("row", "kept").collect()
    want = [(i, t) for i, t in enumerate(texts)] + [(None, "ÿa"), (None, "b")]
    assert len(done) == len(want)
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in done)
    assert got == collections.Counter((i, *brute_fim(i, t)) for i, t in want)
    for r in done:
        assert r.restored == (r.text or "") and (r.p, r.m) == (r.prefix_chars, r.middle_chars) and r.kept == 7
    forms = collections.Counter(r.form for r in done)
    assert forms["psm"] > forms["spm"] > 20 and forms["plain"] > 20


def test_fim_small_tables_and_broken_outputs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.transform(empty)).count() == 0
    rows = spark.createDataFrame(
        [("<P>a<S>b", "psm"), ("a<S>b<M>c", "psm"), (None, "psm"), ("x", None), ("x", "odd"), ("<S>s<P>p<M>m", "spm")],
        "output string, form string")
    assert [r.restored for r in fim.restore(rows).collect()] == [None, None, None, None, None, "pms"]


def test_index_of_exceptions_converts_both_ways():
    rng = random.Random(6)
    texts = ["".join(rng.choices("aß漢🙂", k=rng.randint(0, 20))) for _ in range(50)] + ["", "abc"]
    data, offsets = text_bytes(pa.array(texts))
    index = fim.Exceptions(data, offsets)
    assert list(index.sizes()) == [len(t) for t in texts] and len(index.at) == sum(c != "a" and c not in "bc" for t in texts for c in t)
    for i, t in enumerate(texts):
        for cut in range(len(t) + 1):
            place = offsets[i] + len(t[:cut].encode())
            assert index.to_bytes(np.array([i]), np.array([cut]))[0] == place
            assert index.to_points(np.array([i]), np.array([place]))[0] == cut


def test_a_worker_learns_runs_once_for_all_its_tasks():
    """The next task of a worker finds what the last one has learned."""
    model = packing.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    column = pa.array(["some words, twice some words", "more"])
    ids, first = packing.memory_of(model).encode(column, 1)
    known = dict(packing.memory_of(model).place)
    again, first_again = packing.memory_of(model).encode(column, 1)
    assert packing.memory_of(model) is packing.memory_of(model) and packing.memory_of(model).place == known
    assert ids.tolist() == again.tolist() and first.tolist() == first_again.tolist()
