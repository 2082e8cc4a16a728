"""Gates: each defect is caught and named, and good rules pass."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from clauseloom.functions import language
from clauseloom.model import LOAN_VOCABULARY
from clauseloom.operators import blocking, checks, expressions, gates, report

# Fixed published samples: the quote, the rules and expressions below are given test values.
QUOTE = "no later than three business days before consummation"
GOOD = (
    "count(derived.business_days as day, d(day) >= d(derived.cd_receipt_date)"
    " and d(day) < d(closing_date)) >= 3"
)


def lint(spark, texts, notation="expression"):
    """{position: findings} of (text, quote) pairs, all in one corpus."""
    rows = [(str(i), text, quote) for i, (text, quote) in enumerate(texts)]
    frame = spark.createDataFrame(rows, "rule_id string, text string, quote string")
    out = {i: set() for i in range(len(texts))}
    for gate in (gates.number_gate, gates.vocabulary_gate, gates.encoding_gate, gates.forbidden_constructs):
        for r in gate(frame, "text", notation).collect():
            out[int(r.subject)].add((r.check, r.detail))
    return out


DEFECTS = [
    ("count(derived.business_days, true) >= 4", QUOTE, ("number", "number 4 is not stated")),
    ("d(cd.closing) >= d(closing_date)", QUOTE, ("vocabulary", "field cd.closing")),
    ("len(derived.business_days) >= 3 and upper('a') == 'A'", QUOTE, ("vocabulary", "function upper")),
    ("filter(derived.business_days, true)[-3] != null", QUOTE, ("number", "index [-3] is not allowed")),
    ("filter(derived.business_days, true)[3] != null", QUOTE, ("number", "index [3] (element 4) is not stated")),
    ("d(closing_date).weekday() != 7", QUOTE, ("encoding", "weekday 7")),
    ("closing_date >=", QUOTE, ("construct", "the text ends in the middle")),
    ("ltv = 1", QUOTE, ("construct", "assignment")),
    ("d(closing_date", QUOTE, ("construct", "brackets do not match")),
    ("`x`", QUOTE, ("construct", "template string")),
    ("$ > 3", QUOTE, ("construct", "$ (value of the tested column)")),
    ("ltv > 3; ltv < 3", QUOTE, ("construct", "several statements")),
    ("{a: ltv}", QUOTE, ("construct", "object literal")),
    ("ltv > -3", QUOTE, ("number", "number -3 is not stated")),
    ("ltv > 3.5", "more than 3.50 percent, not 35", None),
    ("d(closing_date).endOf(\"M\") > d(closing_date)", QUOTE, ("vocabulary", "method endOf")),
    (GOOD, QUOTE, None),
    ("filter(derived.business_days as day, d(day) > d(cd.mailed_date))[2]", QUOTE, None),
    ("d(#).weekday() != 7 and not contains(calendar.holidays, #)", "all days except Sundays", None),
    ("7 != d(#).weekday()", "except on a SUNDAY", None),
    ("cd.delivery_method == \"in_person\" ? cd.received_date : cd.mailed_date", QUOTE, None),
    ("", QUOTE, None),
    ('7 == d(cd.issue_date).add(1, "d").weekday()', "1 day, no Sunday", None),
    ('7 == d(cd.issue_date).add(1, "d").weekday()', "1 day", ("encoding", "weekday 7")),
    ("(d(filter(calendar.holidays, d(#) > d(closing_date))[0]).sub(1, \"d\").weekday()) != 7", "first, 1, Sunday", None),
    ("calendar.holidays[0].weekday() != 7", "the first is no Sunday", None),
    ("d(closing_date).weekday() + 1 == 7", "a Sunday", ("number", "number 7 is not stated")),
    ("7 == 1 + d(closing_date).weekday()", "a Sunday", ("number", "number 7 is not stated")),
    ("d(closing_date).weekday() == 6 + 7", "a Sunday", ("number", "number 6 is not stated")),
    ("d(closing_date.weekday()) == 7", "a Sunday", ("number", "number 7 is not stated")),
    ("d(closing_date).weekday() == -7", "a Sunday", ("encoding", "weekday -7")),
    ("d(closing_date)) == 7", "a Sunday", ("number", "number 7 is not stated")),
]
FEEL_DEFECTS = [
    ("derived_business_days[date(item) > date(cd.mailed_date)][2]", QUOTE, ("number", "index [2] (element 2) is not stated")),
    ("calendar.holidays[-1] != null", QUOTE, ("number", "index [-1] is not allowed")),
    ('date(cd.mailed_date) + duration("P4D")', QUOTE, ("number", "duration of 4 is not stated")),
    ('date(cd.mailed_date) + duration("PT4H")', QUOTE, ("construct", "duration literal PT4H")),
    ("date(note.limit) < today()", QUOTE, ("vocabulary", "field note.limit")),
    ("business_days(closing_date) > 3", QUOTE, ("vocabulary", "function business_days")),
    ('day of week(date(item)) != "Sunday"', QUOTE, ("encoding", "weekday Sunday")),
    ('day of week(date(item)) != "Funday"', "Sundays", ("construct", "day name Funday")),
    ("{a: ltv}", QUOTE, ("construct", "context literal")),
    ("derived_business_days[date(item) > date(cd.mailed_date)][3]", QUOTE, None),
    ('date(cd.mailed_date) + duration("P3D")', QUOTE, None),
    ('day of week(date(item)) != "Sunday" and not(list  contains(calendar.holidays, item))', "except Sundays", None),
    ("-", QUOTE, None),
    ('"Sunday" != day of week(date(calendar.holidays[date(item) > date(closing_date)][1]))', "first Sunday", None),
    ('(day  of week(date(closing_date) + duration("P1D"))) = "Sunday"', "1", ("encoding", "weekday Sunday")),
    ('string(day of week(date(closing_date))) = "Sunday"', "x", None),
]


@pytest.mark.parametrize("notation, cases", [("expression", DEFECTS), ("feel", FEEL_DEFECTS)])
def test_defects_are_named_and_good_rules_pass(spark, notation, cases):
    found = lint(spark, [(text, quote) for text, quote, _ in cases], notation)
    for i, (text, _, finding) in enumerate(cases):
        if finding is None:
            assert found[i] == set(), text
        else:
            assert finding in found[i], (text, found[i])


def test_day_test_mentions_the_day(spark):
    frame = spark.createDataFrame(
        [("a", "ltv > 3", "ltv > 3"), ("b", "d(#) > d(closing_date)", "date(item) > date(closing_date)"),
         ("c", "flood_zone == \"#\"", "flood_zone = \"item\"")],
        "rule_id string, first string, feel string",
    )
    for text, notation in (("first", "expression"), ("feel", "feel")):
        silent = gates.day_test_gate(frame, text, notation).collect()
        assert {r.subject for r in silent} == {"a", "c"}


def test_uses_of_the_documented_examples(spark):
    frame = spark.createDataFrame(
        [("a", "filter(items as day, day.ok)"), ("b", "closing_date.add(3, \"d\").isBefore(d(x.y))")],
        "rule_id string, text string",
    )
    got = {(r.rule_id, r.kind, r["name"]) for r in expressions.uses(frame, "text", "expression", ["rule_id"]).collect()}
    assert got == {
        ("a", "function", "filter"), ("a", "field", "items"),
        ("b", "field", "closing_date"), ("b", "method", "add"), ("b", "number", "3"),
        ("b", "method", "isBefore"), ("b", "function", "d"), ("b", "field", "x.y"),
    }


def test_allow_lists(spark):
    listed = spark.createDataFrame([("function", "d"), ("method", "weekday"), ("function", "eval")], "kind string, name string")
    assert [r.subject for r in gates.allowlist_gate(listed).collect()] == ["eval"]
    assert gates.allowlist_gate(gates.listed_names(spark)).count() == 0
    odd = replace(LOAN_VOCABULARY, functions=(*LOAN_VOCABULARY.functions, "eval"), methods=("weekday", "shift"))
    found = {(r.subject, r.detail) for r in gates.allowlist_gate(gates.listed_names(spark, odd)).collect()}
    assert found == {("eval", "function is not documented"), ("shift", "method is not documented")}
    assert len(language.EXPRESSION_FUNCTIONS) == 42 and len(language.DATE_METHODS) == 29
    assert len(language.FEEL_FUNCTIONS) == 99


def test_quotes_and_sources_with_a_hot_sentence(spark):
    receipts = spark.range(3000).select(
        F.concat(F.lit("r"), "id").alias("rule_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("sentence_id"),
        F.when(F.col("id") % 100 == 0, "not there").otherwise("three days").alias("quote"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 50)).alias("source"),
        F.when(F.col("id") % 90 == 0, "old").otherwise("new").alias("source_sha256"),
    )
    sentences = spark.createDataFrame(
        [("hot", "within three days")] + [(f"s{i}", "three days") for i in range(40)], "sentence_id string, text string"
    )
    found = gates.quote_missing(receipts, sentences).collect()
    unknown = {f"r{i}" for i in range(3000) if i % 3 and i % 50 >= 40}
    absent = {f"r{i}" for i in range(3000) if i % 100 == 0} - unknown
    assert {r.subject for r in found if r.detail.startswith("unknown")} == unknown
    assert {r.subject for r in found if r.detail.startswith("quote not")} == absent
    assert len(found) == len(unknown) + len(absent)
    sources = spark.createDataFrame([("hot", "new")] + [(f"f{i}", "new") for i in range(50)], "source string, sha256 string")
    drifted = gates.source_drift(receipts, sources).collect()
    assert {r.subject for r in drifted} == {f"r{i}" for i in range(0, 3000, 90)}


RECEIPTS = [("a/r1", "rule", "x", "y"), ("b/r1", "rule", "x", "z"), ("c/d1", "derived_field", None, None)]
ROWS = [
    ("a/r1/pass", "a/r1", "x", "y", "pass"), ("a/r1/fail", "a/r1", "x", "not (y)", "fail"),
    ("b/r1/pass", "b/r1", "x", "z", "pass"), ("b/r1/fail", "b/r1", "x", "z", "fail"),
    ("q/r1/pass", "q/r1", "x", "z", "pass"),
]


def test_rows_against_receipts(spark):
    receipts = spark.createDataFrame(RECEIPTS, "rule_id string, kind string, applies_when string, requirement string")
    rows = spark.createDataFrame(ROWS, "row_id string, rule_id string, i1 string, i2 string, result string")
    assert [(r.subject, r.detail) for r in gates.row_mismatch(receipts, rows).collect()] == [("b/r1/fail", "row differs")]
    fewer = rows.where("row_id <> 'a/r1/pass'")
    assert ("a/r1/pass", "missing row") in {(r.subject, r.detail) for r in gates.row_mismatch(receipts, fewer).collect()}
    assert [(r.subject, r.detail) for r in gates.orphans(receipts, rows).collect()] == [("q/r1", "no receipt")]
    lonely = gates.orphans(receipts, rows.where("rule_id <> 'b/r1'")).collect()
    assert ("b/r1", "no row") in {(r.subject, r.detail) for r in lonely}


def test_graph(spark):
    nodes = spark.createDataFrame([(1, "a", 2, 2), (1, "b", 2, 2), (1, "b", 2, 2), (2, "a", 1, 2)],
                                  "pack int, node_id string, n_inputs int, n_outputs int")
    edges = spark.createDataFrame([(1, "e1", "a", "b"), (2, "e2", "a", "b")],
                                  "pack int, edge_id string, source_id string, target_id string")
    assert {(r.subject, r.detail) for r in gates.graph_integrity(nodes, edges).collect()} == {
        ("1/b", "id is used twice"), ("2/e2", "names no node: 2/b"),
        ("2/a", "needs two inputs and two outputs"),
    }


def test_diff_and_changes(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "rule_id string, content_sha256 string")
    new = spark.createDataFrame([("b", "1"), ("c", "2"), ("d", "1")], "rule_id string, content_sha256 string")
    diff = gates.pack_diff(old, new)
    assert {(r.rule_id, r.change) for r in diff.collect()} == {("a", "retired"), ("c", "changed"), ("d", "added")}
    assert [r.subject for r in gates.unknown_changes(diff, new.where("rule_id <> 'd'")).collect()] == ["d"]


def test_status(spark):
    def frame(*packs):
        return spark.createDataFrame([(p,) for p in packs], "pack string")

    got = gates.pack_status(frame("a", "b", "c", "d"), frame("a", "a"), frame("a", "b"), frame("c")).collect()
    assert {r.pack: (r.status, r.code) for r in got} == {
        "a": ("fail", 1), "b": ("not final", 2), "c": ("not final", 2), "d": ("pass", 0)
    }


def python_blocked(definitions, uses):
    compiled = {r for r, _, open_ in definitions if not open_}
    while True:
        defined = {f for r, f, _ in definitions if r in compiled and f}
        gone = {r for r, f in uses if r in compiled and f not in defined}
        if not gone:
            return {r for r, _, open_ in definitions if not open_} - compiled
        compiled -= gone


def test_blocking_with_shared_fields_and_chains(spark):
    definitions = [("s2", "days", True), ("d1", "receipt", False), ("r1", None, False), ("r2", None, False),
                   ("x", "both", True), ("y", "both", False), ("z", None, False)]
    definitions += [(f"c{i}", f"k{i}", False) for i in range(6)]
    uses = [("d1", "days"), ("r1", "receipt"), ("r2", "other field"), ("z", "both")]
    uses += [(f"c{i}", f"k{i - 1}") for i in range(1, 6)] + [("c0", "days"), ("y", "k5"), ("s2", "nowhere")]
    d = spark.createDataFrame(definitions, "rule_id string, field string, open boolean")
    u = spark.createDataFrame(uses, "rule_id string, field string")
    got = [r.rule_id for r in blocking.blocked_rules(d, u).collect()]
    assert len(got) == len(set(got)) and set(got) == python_blocked(definitions, uses)
    assert "z" in got, "the last rule that defined its field was blocked"


def test_blocking_equals_a_fixpoint_on_tangled_rules(spark):
    """Chains, circles, rules that read several fields and fields of several rules, at random."""
    rng = random.Random(8)
    for size in (12, 40, 90):
        names = [f"f{i}" for i in range(size)]
        definitions = [(f"r{i}", rng.choice([*names, None]), rng.random() < 0.1) for i in range(size)]
        definitions += [(f"r{rng.randrange(size)}", rng.choice(names), False) for _ in range(size // 6)]
        state = {}
        definitions = [(r, f, state.setdefault(r, o)) for r, f, o in definitions]
        uses = [(f"r{rng.randrange(size)}", rng.choice(names)) for _ in range(size)]
        uses += [("r0", "f1"), ("r1", "f0")]
        d = spark.createDataFrame(definitions, "rule_id string, field string, open boolean")
        u = spark.createDataFrame(uses, "rule_id string, field string")
        got = {r.rule_id: r.field for r in blocking.blocked_rules(d, u).collect()}
        want = python_blocked(definitions, uses)
        assert set(got) == want
        left = {f for r, f, o in definitions if f and not o and r not in want}
        assert all(f == min(g for r, g in uses if r == rule and g not in left) for rule, f in got.items())


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    definitions = [(f"r{i:03d}", f"k{i:03d}", False) for i in range(1, 201)] + [("a", "a", False), ("b", "b", False)]
    uses = [(f"r{i:03d}", f"k{i - 1:03d}") for i in range(1, 201)] + [("a", "b"), ("b", "a"), ("c", "a")]
    kept = []
    write = blocking._Tables.__call__
    monkeypatch.setattr(blocking._Tables, "__call__", lambda t, frame, name: kept.append(name) or write(t, frame, name))
    d = spark.createDataFrame(definitions, "rule_id string, field string, open boolean")
    found = blocking.blocked_rules(d, spark.createDataFrame(uses, "rule_id string, field string")).collect()
    assert {r.rule_id: r.field for r in found} == {f"r{i:03d}": f"k{i - 1:03d}" for i in range(1, 201)}
    assert sum(name.startswith("ends-") for name in kept) <= 6


def test_open_questions_and_fixtures(spark):
    q = spark.createDataFrame([("q1",), ("q2",)], "question_id string")
    a = spark.createDataFrame([("q1", "a"), ("q1", "b")], "question_id string, reading_id string")
    assert [r.question_id for r in gates.open_questions(q, a).collect()] == ["q2"]
    f = spark.createDataFrame([("f1", "A"), ("f2", "B")], "fixture_id string, subsection string")
    s = spark.createDataFrame([("A", True), ("A", True), ("B", False)], "subsection string, open boolean")
    assert [r.fixture_id for r in gates.fixture_skip(f, s).collect()] == ["f1"]


def test_coverage(spark):
    tests = spark.createDataFrame([("a", "pass"), ("a", "fail"), ("b", "pass"), ("d", "1"), ("d", "1"), ("e", "1"), ("e", "2")],
                                  "rule_id string, expectation string")
    rules = spark.createDataFrame([("a", "rule"), ("b", "rule"), ("c", "rule"), ("d", "derived_field"), ("e", "derived_field"),
                                   ("g", "derived_field")], "rule_id string, kind string")
    assert {r.rule_id for r in checks.coverage_gaps(tests, rules).collect()} == {"b", "c", "d", "g"}


def test_disagreements_count_repeats(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    other = spark.createDataFrame([(1, None), (3, "y"), (2, "x")], "k int, v string")
    assert {tuple(r) for r in checks.disagreements(one, other).collect()} == {
        (1, None, "one", 1), (3, "y", "other", 1)
    }


def test_readback_and_explanation(spark):
    sentences = spark.createDataFrame([("f", 1, "p", "Scope.", "Text one."), ("f", 2, "p.s2", None, "Text two.")],
                                      "source string, seq int, sentence_id string, heading string, text string")
    states = spark.createDataFrame([("p", "RULE"), ("p.s2", "QUESTION")], "sentence_id string, state string")
    receipts = spark.createDataFrame([("p/r2", "p", "one"), ("p/r1", "p", "Text")], "rule_id string, sentence_id string, quote string")
    links = spark.createDataFrame([("p", "external", "x", "§ x")], "sentence_id string, kind string, target string, cited_as string")
    lines = report.readback(sentences, states, receipts, links)
    assert [r.line for r in report.in_report_order(lines).collect()] == [
        "p Scope", "> Text one.", "State: RULE.", 'Rule p/r1, quote: "Text"', 'Rule p/r2, quote: "one"',
        'Link (external) to x, cited as "§ x"',
        "p.s2", "> Text two.", "State: QUESTION.", "Open question.",
    ]
    edited = lines.withColumn("line", F.replace("line", F.lit("two"), F.lit("2")))
    assert {(r.line, r.side) for r in report.readback_stale(edited, lines).collect()} == {
        ("> Text 2.", "committed"), ("> Text two.", "fresh")
    }
    verdicts = spark.createDataFrame([(7, "p/r1", "pass")], "loan_id int, rule_id string, result string")
    assert tuple(report.explain(verdicts, receipts, sentences).first()) == (7, "p/r1", "pass", "p", "Text", "Text one.")


def test_a_slash_makes_no_two_nodes_one(spark):
    nodes = spark.createDataFrame(
        [("a", "b/c", 2, 2), ("a/b", "c", 2, 2), (None, "x", 2, 2)],
        "pack string, node_id string, n_inputs long, n_outputs long",
    )
    edges = spark.createDataFrame(
        [("a", "e1", "b/c", "b/c"), (None, "e2", "x", "x"), ("a/b", "e3", "c", "b/c")],
        "pack string, edge_id string, source_id string, target_id string",
    )
    assert [r.subject for r in gates.graph_integrity(nodes, edges).collect()] == ["a/b/e3"]


def test_null_quotes_and_sources_are_findings(spark):
    receipts = spark.createDataFrame(
        [("r1", "s", None, None, "h"), ("r2", "s", "text", "f", "h")],
        "rule_id string, sentence_id string, quote string, source string, source_sha256 string",
    )
    sentences = spark.createDataFrame([("s", "the text")], "sentence_id string, text string")
    sources = spark.createDataFrame([("f", "h")], "source string, sha256 string")
    assert [r.detail for r in gates.quote_missing(receipts, sentences).collect()] == ["quote not in s"]
    assert [r.detail for r in gates.source_drift(receipts, sources).collect()] == ["no source null"]


def test_unreadable_files_are_findings(spark):
    from clauseloom.sources.packs import unreadable

    bodies = spark.createDataFrame(
        [("a", '{"rules": {"a/r1": {"kind":"rule"'), ("b", "not json"), ("c", " "), ("d", None), ("e", "{}"), ("f", "[1]")],
        "pack string, body string",
    )
    found = {r.subject: r.detail for r in unreadable(bodies).collect()}
    assert found == {"a": "not a JSON object", "b": "not a JSON object", "c": "empty file",
                     "d": "empty file", "f": "not a JSON object"}


def test_missing_sources_drift_whatever_was_recorded(spark):
    receipts = spark.createDataFrame(
        [("a", "here", "h1"), ("b", "here", "h0"), ("c", "lost", "h1"), ("d", "lost", None), ("e", None, None),
         ("f", "here", None), ("g", "blank", None), ("h", "blank", "h1")],
        "rule_id string, source string, source_sha256 string",
    )
    sources = spark.createDataFrame([("here", "h1"), ("blank", None)], "source string, sha256 string")
    found = {r.subject: r.detail for r in gates.source_drift(receipts, sources).collect()}
    assert found == {
        "b": "hash differs for here", "c": "no source lost", "d": "no source lost", "e": "no source null",
        "f": "hash differs for here", "g": "hash differs for blank", "h": "hash differs for blank",
    }
    recorded = spark.createDataFrame([("here", "h1"), ("lost", None)], "source string, sha256 string")
    assert [r.subject for r in gates.changed_sources(recorded, sources).collect()] == ["lost"]
