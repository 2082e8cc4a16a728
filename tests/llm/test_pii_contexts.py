"""Bootstrapping of personal data: contexts of the seeds, contexts of what they find, and what stays alone."""

from __future__ import annotations

from clauseloom.llm import pii


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.extract(docs).collect()}
    return [
        [(s.split(":")[0], texts[i][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in rows[i].spans.split(",") if s]
        for i in range(len(texts))
    ], rows


SEEDS = [f"please call +1 (555) 555-{1000 + i} word{i}" for i in range(6)]


def test_groups_of_digits_behind_one_word(spark):
    more = ["please call (020) 7946 0958 now", "call 555 123 4567, thanks", "call\t5551234567", "call 12 34 56"]
    got, rows = spans(spark, SEEDS + more)
    assert got[6] == [("phone", "(020) 7946 0958")]
    assert got[7] == [("phone", "555 123 4567")]
    assert got[8] == [("phone", "5551234567")] and got[9] == []
    assert [rows[i].n_added for i in range(6, 10)] == [1, 1, 1, 0]
    assert all(rows[i].n_phone == 0 for i in range(6, 10))
    assert all(len(got[i]) == 1 for i in range(6))


def test_what_is_found_leads_to_more(spark):
    """Unseen numbers behind `call` stand behind `reach`, too, where a number is found that no seed leads to."""
    shared = ["020 7946 0951", "020 7946 0952", "020 7946 0953"]
    texts = SEEDS + [f"call {n} w{i}" for i, n in enumerate(shared)] + [f"reach {n} v{i}" for i, n in enumerate(shared)]
    got, _ = spans(spark, texts + ["reach 030 5555 1234 x"])
    assert got[-1] == [("phone", "030 5555 1234")]
    alone, _ = spans(spark, SEEDS + ["reach 030 5555 1234 x"])
    assert alone[-1] == []


def test_numbers_in_other_contexts_stay(spark):
    """A word that mostly stands before other numbers is no context, however many seeds it has."""
    texts = [f"order +1 (555) 555-{1000 + i} a{i}" for i in range(6)]
    texts += [f"order 2024 1000 {1000 + i} b{i}" for i in range(20)]
    got, rows = spans(spark, texts)
    assert all(g == [] for g in got[6:]) and all(rows[i].n_added == 0 for i in range(26))


def test_long_words_ends_ties_and_repeated_rows(spark):
    long = "x" * 5000
    texts = [f"{long} +1 (555) 555-{1000 + i} {long}" for i in range(4)]
    texts += [f"{long} 020 7946 0958 {long}"] * 2 + [f"{long}y 020 7946 0958", "020 7946 0958", "", None]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id int, text string")
    got = sorted((r.n_phone, r.n_added) for r in pii.extract(docs).collect())
    assert got == [(0, 0)] * 4 + [(0, 1)] * 2 + [(1, 0)] * 4


def test_long_lists_of_numbers(spark):
    got, _ = spans(spark, [" ".join(str(1000 + i) for i in range(5000)), "1 " * 3000])
    assert got == [[], []]


def test_each_number_is_of_one_kind(spark):
    """Twelve digits could be of a phone or of a card."""
    texts = [f"card 4111 1111 1111 1111 w{i}" for i in range(2)] + ["card 5500 0000 0000 0004 x", "card 3400 0000 0000 0009 0 x"]
    texts += [f"card {n} z" for n in ("4012888888881881", "4222222222222220", "6011111111111117", "5105105105105100")]
    got, _ = spans(spark, texts + ["card 3782 822463 1000 y"])
    assert got[-1] == [("card", "3782 822463 1000")]
