"""Decision tables, the rule language, pack files."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from clauseloom.functions import language
from clauseloom.operators import audit, gates, rule_tables, tables
from clauseloom.sources import packs

DISCOUNTS = ({"tier": '"gold"', "total": ">= 100", "discount": 0.15}, {"tier": "", "total": "-", "discount": 0.0})
PRICES = ({"total": "< 100", "tier": "STANDARD"}, {"total": ">= 100", "tier": "PREMIUM"})


def test_first_hit(spark):
    facts = spark.createDataFrame([("gold", 150.0), ("silver", 150.0), ("gold", 99.0), (None, None)], "tier string, total double")
    got = tables.first_hit(facts, {"tier": "tier", "total": "total"}, DISCOUNTS, "discount", "discount")
    assert [r.discount for r in got.collect()] == [0.15, 0.0, 0.0, 0.0]


def test_unique_hit(spark):
    facts = spark.createDataFrame([(50.0,), (150.0,), (None,)], "total double")
    got = tables.unique_hit(facts, {"total": "total"}, PRICES, "tier", "tier").collect()
    assert [(r.tier, r.n_hits, r.violation) for r in got] == [
        ("STANDARD", 1, False), ("PREMIUM", 1, False), (None, 0, False)
    ]
    overlap = (*PRICES, {"total": "> 120", "tier": "EXTRA"})
    got = tables.unique_hit(facts, {"total": "total"}, overlap, "tier", "tier").collect()
    assert [(r.tier, r.violation) for r in got] == [("STANDARD", False), (None, True), (None, False)]


def test_collect_keeps_table_order_and_an_empty_list(spark):
    facts = spark.createDataFrame([(50.0,), (None,)], "total double")
    got = tables.collect_rows(facts, {"total": "total"}, ({"total": "> 10", "r": "b"}, {"total": "!= 3", "r": "a"}), "r", "hits")
    assert [r.hits for r in got.collect()] == [["b", "a"], []]


@pytest.mark.parametrize("cell, hits", [("", 5), ("-", 4), ('"x"', 1), (' "y" ', 0), ("= 5", 1), ("5", 1), ("<= 5", 2), ("> 5", 1)])
def test_cells(spark, cell, hits):
    if '"' in cell:
        facts = spark.createDataFrame([("x",), ("z",), (None,)], "f string")
    else:
        facts = spark.createDataFrame([(5.0,), (4.0,), (6.0,), (None,)], "f double")
    n = facts.where(tables.row_predicates({"f": "f"}, ({"f": cell},))[0]).count()
    assert n == (4 if cell in ("", "-") else hits)


# name -> arguments and value, for each call that has a fixed value.
EXPRESSIONS = {
    "abs": ("-2", 2), "floor": ("1.7", 1), "ceil": ("1.2", 2), "round": ("1.5", 2), "trunc": ("-1.7", -1),
    "min": ("array(3, 1)", 1), "max": ("array(3, 1)", 3), "sum": ("array(1, 2)", 3.0), "avg": ("array(1, 2)", 1.5),
    "median": ("array(5, 1, 3)", 3.0), "mode": ("array(1, 2, 2)", 2), "len": ("array(1, 2)", 2),
    "upper": ("'a'", "A"), "lower": ("'A'", "a"), "trim": ("' a '", "a"), "contains": ("array(1, 2)", "2", True),
    "startsWith": ("'abc'", "'a'", True), "endsWith": ("'abc'", "'c'", True), "matches": ("'abc'", "'b'", True),
    "extract": ("'a1b2'", "'[0-9]'", ["1", "2"]), "split": ("'a,b'", "','", ["a", "b"]),
    "fuzzyMatch": ("'abcd'", "'abcx'", 0.75), "map": ("array(1, 2)", "x + 1", [2, 3]),
    "filter": ("array(1, 2)", "x > 1", [2]), "some": ("array(1, 2)", "x > 1", True),
    "all": ("array(1, 2)", "x > 1", False), "one": ("array(1, 2)", "x > 1", True),
    "none": ("array(1, 2)", "x > 2", True), "count": ("array(1, 2)", "x > 0", 2),
    "flatMap": ("array(1, 2)", "array(x, x)", [1, 1, 2, 2]), "keys": ("map('a', 1)", ["a"]),
    "values": ("map('a', 1)", [1]), "merge": ("map('a', 1)", "map('b', 2)", {"a": 1, "b": 2}),
    "mergeDeep": ("map('a', map('x', 1))", "map('a', map('y', 2))", {"a": {"x": 1, "y": 2}}),
    "d": ("'2026-10-12'", date(2026, 10, 12)), "string": ("3", "3"), "number": ("'2.5'", 2.5),
    "bool": ("'true'", True), "type": ("'a'", "string"), "isNumeric": ("'x'", False),
}
D = "date'2026-10-11'"
METHODS = {
    "year": (D, 2026), "month": (D, 10), "day": (D, 11), "weekday": (D, 7), "hour": (D, 0), "minute": (D, 0),
    "second": (D, 0), "dayOfYear": (D, 284), "quarter": (D, 4), "timestamp": (D, 1791676800000),
    "set": (D, "2024", date(2024, 10, 11)), "add": (D, "3", date(2026, 10, 14)), "sub": (D, "1", date(2026, 10, 10)),
    "isBefore": (D, "date'2026-10-12'", True), "isAfter": (D, "date'2026-10-12'", False), "isSame": (D, D, True),
    "isSameOrBefore": (D, D, True), "isSameOrAfter": (D, D, True), "diff": ("date'2024-01-15'", "date'2024-01-10'", 5),
    "startOf": (D, "'month'", date(2026, 10, 1)), "endOf": (D, date(2026, 10, 31)), "isValid": (D, True),
    "isToday": (D, False), "isYesterday": (D, False), "isTomorrow": (D, False), "isLeapYear": ("date'2024-05-01'", True),
    "format": (D, "2026-10-11"), "offsetName": (D, "UTC"),
}
R = "named_struct('lo', {}, 'hi', {})"
FEEL = {
    "not": ("true", False), "is defined": ("null", False), "get or else": ("null", "1", 1), "assert": ("1", "true", 1),
    "substring": ("'foobar'", "3", "2", "ob"), "string length": ("'abc'", 3), "upper case": ("'a'", "A"),
    "lower case": ("'A'", "a"), "substring before": ("'foobar'", "'bar'", "foo"),
    "substring after": ("'foobar'", "'ob'", "ar"), "contains": ("'abc'", "'b'", True), "starts with": ("'abc'", "'a'", True),
    "ends with": ("'abc'", "'c'", True), "matches": ("'abc'", "'b+'", True), "replace": ("'abc'", "'b'", "'x'", "axc"),
    "split": ("'a;b'", "';'", ["a", "b"]), "extract": ("'a1'", "'[0-9]'", ["1"]), "trim": ("' a '", "a"),
    "to base64": ("'FEEL'", "RkVFTA=="), "from base64": ("'RkVFTA=='", "FEEL"), "is blank": ("' '", True),
    "string join": ("array('a', 'b')", "','", "a,b"), "floor": ("1.5", 1), "ceiling": ("1.5", 2),
    "round up": ("5.5", "0", 6.0), "round down": ("-5.5", "0", -5.0), "round half down": ("5.5", "0", 5.0),
    "abs": ("-1", 1), "modulo": ("-12", "5", 3), "sqrt": ("16", 4.0), "exp": ("0", 1.0), "log": ("1", 0.0),
    "odd": ("5", True), "even": ("5", False), "list contains": ("array(1)", "1", True), "count": ("array(1, 2)", 2),
    "min": ("array(2, 1)", 1), "max": ("array(2, 1)", 2), "sum": ("array(1, 2)", 3.0), "product": ("array(2, 3)", 6.0),
    "mean": ("array(1, 2, 3)", 2.0), "median": ("array(6, 1, 2, 3)", 2.5), "stddev": ("array(2, 4, 6)", 2.0),
    "mode": ("array(6, 1, 9, 6, 1)", [1, 6]), "all": ("array(true, false)", False), "any": ("array(true, false)", True),
    "sublist": ("array(1, 2, 3)", "2", "2", [2, 3]), "append": ("array(1)", "2", [1, 2]),
    "concatenate": ("array(1)", "array(2)", [1, 2]), "insert before": ("array(1, 3)", "1", "2", [2, 1, 3]),
    "remove": ("array(1, 2, 3)", "2", [1, 3]), "reverse": ("array(1, 2)", [2, 1]), "index of": ("array(1, 2, 1)", "1", [1, 3]),
    "union": ("array(1, 2)", "array(2, 3)", [1, 2, 3]), "distinct values": ("array(1, 1)", [1]),
    "duplicate values": ("array(1, 2, 1)", [1]), "flatten": ("array(array(1), array(2))", [1, 2]),
    "sort": ("array(2, 1)", [1, 2]), "partition": ("array(1, 2, 3)", "2", [[1, 2], [3]]), "is empty": ("array()", True),
    "get value": ("map('a', 1)", "'a'", 1), "context put": ("map('a', 1)", "'a'", "2", {"a": 2}),
    "context merge": ("map('a', 1)", "map('a', 2)", {"a": 2}), "day of week": (D, "Sunday"), "day of year": (D, 284),
    "week of year": (D, 41), "month of year": (D, "October"), "last day of month": (D, date(2026, 10, 31)),
    "before": (R.format(1, 2), R.format(3, 4), True), "after": (R.format(1, 2), R.format(3, 4), False),
    "meets": (R.format(1, 2), R.format(2, 4), True), "met by": (R.format(2, 4), R.format(1, 2), True),
    "overlaps": (R.format(1, 3), R.format(2, 4), True), "overlaps before": (R.format(1, 3), R.format(2, 4), True),
    "overlaps after": (R.format(1, 3), R.format(2, 4), False), "finishes": (R.format(3, 4), R.format(1, 4), True),
    "finished by": (R.format(1, 4), R.format(3, 4), True), "includes": (R.format(1, 4), R.format(2, 3), True),
    "during": (R.format(2, 3), R.format(1, 4), True), "starts": (R.format(1, 2), R.format(1, 4), True),
    "started by": (R.format(1, 4), R.format(1, 2), True), "coincides": (R.format(1, 4), R.format(1, 4), True),
    "string": ("1", "1"), "number": ("'1.5'", 1.5), "date": ("'2026-02-30'", None),
    "years and months duration": ("date'2011-12-22'", "date'2013-08-24'", 20), "decimal": ("2.5", "0", 2),
}
# Calls whose value changes or is not plain: they only have to run.
RUNS = {
    "operator": {},
    "expression": {"rand": ("5",), "duration": ("'3 00:00:00'",)},
    "method": {"tz": (D, "'Europe/Paris'")},
    "feel": {
        "uuid": (), "random number": (), "now": (), "today": (), "date and time": ("'2026-10-11 10:00:00'",),
        "duration": ("'3 00:00:00'",), "time": ("'10:00:00'",), "get entries": ("map('a', 1)",),
        "context": ("array(named_struct('key', 'a', 'value', 1))",), "to json": ("map('a', 1)",),
        "from json": ("'{\"a\": 1}'", "'a int'"), "round half up": ("5.5", "0"),
    },
}
OPERATORS = {
    "and": ("true", "null", None), "or": ("true", "null", True), "not": ("cast(null as boolean)", None),
    "==": ("1", "1", True), "=": ("1", "2", False), "!=": ("1", "2", True), "<": ("1", "2", True), ">": ("1", "2", False),
    "<=": ("1", "1", True), ">=": ("null", "1", None), "in": ("1", "array(1, 2)", True), "not in": ("1", "array(1)", False),
    "in [a..b]": ("1", "1", "3", True), "in (a..b)": ("1", "1", "3", False), "+": ("1", "2", 3), "-": ("1", "2", -1),
    "*": ("2", "3", 6), "/": ("1", "0", None), "%": ("7", "4", 3), "^": ("2", "3", 8.0), "**": ("2", "3", 8.0),
    "? :": ("cast(null as boolean)", "1", "2", 2), "if then else": ("true", "1", "2", 1), "??": ("null", "1", 1),
    "x[n] from 0": ("array(10, 20)", "2", None), "x[n] from 1": ("array(10, 20)", "2", 20),
    "x[test]": ("array(10, 20)", "x > 10", [20]), "[a..b]": ("0", "2", [0, 1, 2]),
    "for in return": ("0", "2", "x * 2", [0, 2, 4]), "[a, b]": ("1", "2", [1, 2]),
    ".days": ("date'2026-10-19'", "date'2026-10-09'", 10), "+ PnD": (D, "3", date(2026, 10, 14)),
    "- PnD": (D, "11", date(2026, 9, 30)), "+ PnW": (D, "1", date(2026, 10, 18)),
    "+ PnM": ("date'2026-01-31'", "1", date(2026, 2, 28)), "+ PnY": (D, "1", date(2027, 10, 11)),
}
CATALOGUES = {
    "operator": (language.OPERATORS, OPERATORS),
    "expression": (language.EXPRESSION_FUNCTIONS, EXPRESSIONS),
    "method": (language.DATE_METHODS, METHODS),
    "feel": (language.FEEL_FUNCTIONS, FEEL),
}


@pytest.mark.parametrize("name", CATALOGUES)
def test_every_call_of_the_language(spark, name):
    table, values = CATALOGUES[name]
    assert set(table) == set(values) | set(RUNS[name])
    calls = [(n, v[:-1], v[-1]) for n, v in values.items()]
    row = spark.range(1).select(
        *[F.expr(language.spark_sql(n, *args, table=table)).alias(f"v{i}") for i, (n, args, _) in enumerate(calls)],
        *[F.expr(language.spark_sql(n, *args, table=table)).alias(f"r{i}") for i, (n, args) in enumerate(RUNS[name].items())],
    ).first()
    wrong = {}
    for i, (n, _, want) in enumerate(calls):
        got = row[f"v{i}"]
        same = got == pytest.approx(want) if isinstance(want, float) else got == want
        if not same:
            wrong[n] = (got, want)
    assert wrong == {}


PACK = {
    "links": [{"sentence_id": "p", "kind": "external", "target": "x", "cited_as": "§ x", "quote": "see x"}],
    "rules": {
        "p/r1": {"kind": "rule", "sentence_id": "p", "source": "s.txt", "quote": "three days", "applies_when": "",
                 "requirement": "ltv > 3", "dmn": {"decision": "sp", "rules": ["rule_p_r1_pass"]}},
        "p/d1": {"kind": "derived_field", "sentence_id": "p", "field": "derived.x", "expression": "1"},
    },
    "sentences": {"p": {"source": "s.txt", "state": "RULE"}},
    "sources": {"s.txt": {"sha256": "00"}},
}
MODEL = {
    "nodes": [
        {"id": "input", "type": "inputNode", "name": "in", "content": {"schema": ""}},
        {"id": "derive", "type": "expressionNode", "name": "d",
         "content": {"expressions": [{"id": "e1", "key": "derived.x", "value": "1"}]}},
        {"id": "t", "type": "decisionTableNode", "name": "t", "content": {
            "hitPolicy": "collect", "outputPath": "results.sp",
            "rules": [{"_id": "p/r1/pass", "i1": "", "i2": "ltv > 3", "o1": "\"p/r1\"", "o2": "\"pass\""},
                      {"_id": "p/r1/fail", "i1": "", "i2": "not (ltv > 3)", "o1": "\"p/r1\"", "o2": "\"fail\""}]}},
    ],
    "edges": [{"id": "e", "sourceId": "input", "targetId": "gone"}],
}
DMN = """<?xml version="1.0" encoding="UTF-8"?>
<definitions xmlns="https://www.omg.org/spec/DMN/20191111/MODEL/" id="m" name="m">
  <decision id="derived_x" name="x"><informationRequirement id="i"><requiredInput href="#input_ltv" />
    </informationRequirement><literalExpression id="l"><text>1</text></literalExpression></decision>
  <decision id="sp" name="table"><decisionTable id="dt" hitPolicy="COLLECT">
    <rule id="rule_p_r1_pass"><description>p/r1/pass</description>
      <inputEntry id="a"><text>true</text></inputEntry><inputEntry id="b"><text>ltv &gt; 3</text></inputEntry>
      <outputEntry id="c"><text>"p/r1"</text></outputEntry><outputEntry id="d"><text>"pass"</text></outputEntry>
    </rule></decisionTable></decision>
</definitions>"""
QUESTIONS = """
questions:
- id: q1
  sentence_id: p
  issue: 'which: this'
  readings:
  - {id: a, reading: first}
blocked:
- {id: p/r1, sentence_id: p, reason: waits}
skipped_fixtures: []
"""
ANSWERS = "answers:\n- {question_id: q1, sentence_id: p, reading_id: a, reading: first, answered_by: someone}\n"


@pytest.fixture(scope="module")
def pack(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("packs")
    for name in ("one", "two"):
        (root / name).mkdir()
        (root / name / "receipts.json").write_text(json.dumps(PACK, indent=2))
        (root / name / "rules.jdm.json").write_text(json.dumps(MODEL))
        (root / name / "rules.dmn").write_text(DMN)
        (root / name / "changes.json").write_text(json.dumps({"added": ["p/r1"], "changed": [], "retired": ["z"], "previous": "00"}))
        (root / name / "questions.yaml").write_text(QUESTIONS)
        (root / name / "answers.yaml").write_text(ANSWERS)
    return packs.read_pack(spark, str(root / "*"))


def test_pack_relations(pack):
    assert pack["receipt"].count() == 4 and pack["link"].count() == 2
    one = pack["receipt"].where("rule_id = 'p/r1'").first()
    assert one.requirement == "ltv > 3" and one.dmn.rules == ["rule_p_r1_pass"] and one.pack.endswith(("/one", "/two"))
    assert {(r.row_id, r.rule_id, r.result) for r in pack["row"].collect()} == {
        ("p/r1/pass", "p/r1", "pass"), ("p/r1/fail", "p/r1", "fail")
    }
    assert [(r.field, r.expression) for r in pack["derived_node"].distinct().select("field", "expression").distinct().collect()] == [("derived.x", "1")]
    rule = pack["dmn_rule"].first()
    assert (rule.decision, rule.xml_id, rule.applies_when, rule.requirement, rule.rule_id, rule.result) == (
        "sp", "rule_p_r1_pass", "true", "ltv > 3", "p/r1", "pass"
    )
    kinds = {(r.decision, r.kind, tuple(r.requires or ())) for r in pack["decision"].collect()}
    assert kinds == {("derived_x", "literal", ("input_ltv",)), ("sp", "table", ())}
    assert {(r.change, r.rule_id) for r in pack["change"].collect()} == {("added", "p/r1"), ("retired", "z")}
    assert {(r.part, r.id, r.reading_id) for r in pack["question"].collect()} == {
        ("question", "q1", None), ("reading", "q1", "a"), ("blocked", "p/r1", None), ("answer", "q1", "a")
    }


def test_input_entries(spark):
    cells = ["", " ltv > 3 ", "not(a)", "not(a) and not(b)", "not(f(\")\") = (1))", "not(a", "(not(a))"]
    frame = spark.createDataFrame(enumerate(cells), "i int, c string")
    got = [r.e for r in frame.select("i", gates.input_entry(F.col("c")).alias("e")).orderBy("i").collect()]
    assert got == ["-", "ltv > 3", "(not(a))", "not(a) and not(b)", "(not(f(\")\") = (1)))", "not(a", "(not(a))"]


def test_model_text_of_a_day_set(spark):
    frame = spark.createDataFrame(
        [("derived.business_days", "T"), ("derived.cd_receipt_date", "T")], "field string, text string"
    )
    for notation, start in (("expression", "filter(map([0..d(closing_date, "), ("feel", "(for i in 0..(date(closing_date)")):
        got = [r.m for r in frame.select(gates.model_text(F.col("text"), notation).alias("m")).collect()]
        assert got[0].startswith(start) and got[0].endswith((", T)", ")[T]")) and "{" not in got[0]
        assert got[1] == "T"


def test_audit(spark, pack):
    one = {k: v.where(F.col("pack").endswith("/one")) for k, v in pack.items()}
    sentences = spark.createDataFrame([("p", "Within three days.")], "sentence_id string, text string")
    sources = spark.createDataFrame([("s.txt", "01")], "source string, sha256 string")
    found = {(r.check, r.subject, r.detail) for r in audit.audit(one, sentences, sources).collect()}
    assert ("quote", "p/r1", "quote not in p") not in found
    assert ("source", "p/r1", "hash differs for s.txt") in found
    assert ("source", "s.txt", "changed since the pack was built") in found
    assert ("dmn rule", "rule_p_r1_fail", "missing dmn rule") in found
    assert ("derived field", "p/d1", "derived.x is not a derived field of the vocabulary") in found
    assert ("decision", "p/d1", "no receipt in the second model") in found
    assert ("number", "p/r1", "number 3 is not stated") not in found
    assert ("derived field", "p/d1", "the model differs from the receipt") in found


def test_gates_over_a_pack_that_was_read(pack):
    one = {k: v.where(F.col("pack").endswith("/one")) for k, v in pack.items()}
    assert gates.row_mismatch(one["receipt"], one["row"]).count() == 0
    assert gates.orphans(one["receipt"], one["row"]).count() == 0
    derived = one["receipt"].where("kind = 'derived_field'")
    built = one["derived_node"].join(derived.select("rule_id", "field"), "field")
    assert gates.derived_mismatch(derived, built).count() == 0
    nodes = one["node"].select("pack", "node_id", F.lit(2).alias("n_inputs"), F.lit(2).alias("n_outputs"))
    assert [r.detail[-4:] for r in gates.graph_integrity(nodes, one["edge"]).collect()] == ["gone"]


def test_packs_with_shared_ids_are_kept_apart(spark):
    """Two sound packs whose rules have the same ids: no finding. Then one row of one pack is edited, one
    given twice, one rule is lost in the second format and one has no receipt: four findings, each in its pack."""
    receipts = spark.createDataFrame(
        [(p, r, "rule", "x", need, "x", need) for p, need in (("one", "ltv > 3"), ("two", "ltv > 5")) for r in ("a/r1", "b/r1")],
        "pack string, rule_id string, kind string, applies_when string, requirement string, feel_when string, feel string",
    )
    rows, dmn = gates.expected_rows(receipts), gates.expected_dmn_rows(receipts)

    def found(rows, dmn):
        parts = gates.row_mismatch(receipts, rows).unionByName(gates.dmn_row_mismatch(receipts, dmn)).unionByName(
            gates.orphans(receipts, rows, dmn))
        return sorted((r.pack, r.check, r.subject, r.detail) for r in parts.collect())

    assert found(rows, dmn) == []
    edited = rows.withColumn("i2", F.when(F.expr("pack = 'two' and row_id = 'a/r1/pass'"), "y").otherwise(F.col("i2")))
    twice = edited.unionByName(rows.where("pack = 'one' and row_id = 'b/r1/fail'"))
    stray = twice.unionByName(rows.where("pack = 'one' and row_id = 'b/r1/fail'").withColumns(
        {"rule_id": F.lit("z/r1"), "row_id": F.lit("z/r1/fail")}))
    lost = dmn.where("not (pack = 'two' and rule_id = 'b/r1')")
    assert found(stray, lost) == [
        ("one", "orphan", "z/r1", "no receipt"), ("one", "row", "b/r1/fail", "row is there more than once"),
        ("two", "dmn rule", "rule_b_r1_fail", "missing dmn rule"), ("two", "dmn rule", "rule_b_r1_pass", "missing dmn rule"),
        ("two", "orphan", "b/r1", "no row"), ("two", "row", "a/r1/pass", "row differs"),
    ]


def test_audit_of_several_packs_is_that_of_each(spark, pack):
    sentences = spark.createDataFrame([("p", "Within three days.")], "sentence_id string, text string")
    sources = spark.createDataFrame([("s.txt", "01")], "source string, sha256 string")
    at_once = sorted(tuple(r) for r in audit.audit(pack, sentences, sources).collect())
    packs = sorted({r.pack for r in pack["receipt"].select("pack").collect()})
    singly = []
    for name in packs:
        one = {k: v.where(F.col("pack") == name) for k, v in pack.items()}
        singly += [tuple(r) for r in audit.audit(one, sentences, sources).collect()]
    assert at_once == sorted(singly) and len(packs) > 1


YAML_FILES = {
    "block": "questions:\n- id: q1\n  sentence_id: 's: 1'\n  issue: a plain text\n    over lines, it's \"so\" # no more\n"
             "  readings:\n  - id: a\n    reading: \"first \\\"one\\\"\"\n  - id: b\n    reading: >\n      folded\n      text\n"
             "  quote: ''\n  answer: null\n- id: q2\n  sentence_id: p\n  issue: 'two\n    it''s lines'\n",
    "inline": "# a comment\nanswers:\n  - {question_id: q1, sentence_id: p, reading_id: a, reading: 'x, y', answered_by: me}\n"
              "blocked: []\nskipped_fixtures:\n  - fixture: f\n    subsection: 1(a)\n    reason: waits\n",
    "none": "", "sections only": "questions: []\nanswers:\n",
}
BAD_FILES = {
    "open quote": "questions:\n- id: 'x\n  issue: y\n", "no section": "some text\nmore", "item without section": "- id: a\n",
    "text among keys": "questions:\n- id: a\n  some text\n", "open braces": "answers:\n- {question_id: q\n",
    "top value": "questions: all\n", "anchor": "blocked:\n- id: *other\n",
}


def test_question_files_are_read_as_a_yaml_parser_does(spark):
    """The parser is that of the tests, not of the library."""
    yaml = pytest.importorskip("yaml")
    rows = [(k, v) for k, v in {**YAML_FILES, **BAD_FILES}.items()] + [("null", None)]
    got = packs.question_rows(spark.createDataFrame(rows, "pack string, body string")).collect()
    want = set()
    for pack, text in YAML_FILES.items():
        data = yaml.safe_load(text) or {}
        for q in data.get("questions") or []:
            want.add((pack, "question", q["id"], q["sentence_id"], q["issue"].strip(), None, None))
            for r in q.get("readings") or []:
                want.add((pack, "reading", q["id"], q["sentence_id"], r["reading"].strip(), r["id"], None))
        for a in data.get("answers") or []:
            want.add((pack, "answer", a["question_id"], a["sentence_id"], a["reading"], a["reading_id"], a.get("answered_by")))
        for s in data.get("skipped_fixtures") or []:
            want.add((pack, "skipped_fixture", s["fixture"], s["subsection"], s["reason"], None, None))
    assert {tuple(r) for r in got if r.part != "unreadable"} == want
    assert {r.pack for r in got if r.part == "unreadable"} == set(BAD_FILES)


def test_unreadable_files_of_each_form(spark, tmp_path):
    bodies = spark.createDataFrame(
        [("a", DMN), ("b", "<definitions><decision id="), ("c", "no xml"), ("d", " "), ("e", None), ("f", "<a><b></a>")],
        "pack string, body string")
    found = {r.subject: r.detail for r in packs.unreadable(bodies, form="xml").collect()}
    assert found == {"b": "not an XML document", "c": "not an XML document", "d": "empty file", "e": "empty file",
                     "f": "not an XML document"}
    for name, text in {"receipts.json": "{", "rules.jdm.json": "{}", "changes.json": "[]", "rules.dmn": "<a",
                       "questions.yaml": "questions:\n- id: 'x\n", "answers.yaml": "answers: []\n"}.items():
        (tmp_path / name).write_text(text)
    assert sorted(r.detail for r in packs.unreadable_files(spark, str(tmp_path)).collect()) == [
        "not a JSON object", "not a JSON object", "not a file of questions and answers", "not an XML document"]


def test_tables_as_data_equal_every_row_tried(spark):
    """Intervals of all widths, open and missing bounds, points, any texts, missing fields, empty sides."""
    rng = random.Random(12)
    values = [None, 0.0, -3.5, 7.0, 7.25, 1e9, -1e-3, 123456.75, *[rng.uniform(-50, 50) for _ in range(30)]]
    facts = [(k, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice(values), rng.choice(values)) for k in range(150)]
    rows = []
    for n in range(200):
        lo = rng.choice([v for v in values if v is not None] + [None])
        hi = None if rng.random() < 0.2 else (lo or 0.0) + rng.choice([0.0, 0.001, 3.0, 40.0, 1e6, -1.0])
        other = rng.choice([None, None, -1.0])
        rows.append((n, rng.choice(["a", "b", None]), rng.choice(["x", None, None]), lo, hi, rng.choice([True, False, None]),
                     rng.random() < 0.5, other, None, False, False, f"out{n}"))
    f = spark.createDataFrame(facts, "k int, s string, t string, u double, v double")
    t = spark.createDataFrame(rows, "row_no int, s_eq string, t_eq string, u_lo double, u_hi double, u_lo_open boolean,"
                                    " u_hi_open boolean, v_lo double, v_hi double, v_lo_open boolean, v_hi_open boolean, out string")

    def inside(x, lo, hi, lo_open, hi_open):
        above = lo is None or (x is not None and (x > lo if lo_open else x >= lo))
        return above and (hi is None or (x is not None and (x < hi if hi_open else x <= hi)))

    want = {
        (k, n) for k, s, t_, u, v in facts for n, se, te, lo, hi, lo_o, hi_o, vlo, vhi, *_ in rows
        if se in (None, s) and te in (None, t_) and inside(u, lo, hi, lo_o, hi_o) and inside(v, vlo, vhi, False, False)
    }
    found = rule_tables.matches(f, t, "k", ["s", "t"], ["u", "v"], "out")
    got = [(r.k, r.row_no) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    policies = {r.k: (r.n_hits, r.first_row, r.only) for r in rule_tables.hit_policies(f, found, "k", "out").collect()}
    for k, *_ in facts:
        hits = sorted(n for j, n in want if j == k)
        assert policies[k] == (len(hits), hits[0] if hits else None, f"out{hits[0]}" if len(hits) == 1 else None)
    assert rule_tables.matches(f.limit(0), t, "k", ["s", "t"], ["u", "v"], "out").count() == 0
    assert rule_tables.matches(f, t.limit(0), "k", ["s", "t"], ["u", "v"], "out").count() == 0


def test_counted_matches_equal_every_row_tried(spark, monkeypatch):
    """Slabs of few numbers, frequent numbers, repeated and missing keys, open, missing and inverted bounds."""
    monkeypatch.setattr(rule_tables, "PER_SLAB", 25)
    rng = random.Random(7)
    values = [None, 0.0, 7.0, 7.0, 7.0, float("inf"), *[round(rng.uniform(-50, 50), 1) for _ in range(40)]]
    facts = [(rng.choice([None, *range(150)]), rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice(values))
             for _ in range(300)]
    rows = []
    for n in range(400):
        lo = rng.choice(values)
        hi = rng.choice([None, lo, rng.choice(values), (lo or 0.0) + 0.3, (lo or 0.0) + 30])
        rows.append((n // 2 if n < 20 else n, rng.choice(["a", "b", None]), rng.choice(["x", None, None]), lo, hi,
                     rng.choice([True, False, None]), rng.random() < 0.5, f"out{n}"))
    f = spark.createDataFrame(facts, "k int, s string, t string, u double")
    t = spark.createDataFrame(rows, "row_no int, s_eq string, t_eq string, u_lo double, u_hi double, u_lo_open boolean,"
                                    " u_hi_open boolean, out string")
    found = rule_tables.matches(f, t, "k", ["s", "t"], ["u"], "out", counted=True)

    def hits(fact):
        _, s, t_, u = fact
        for n, se, te, lo, hi, lo_o, hi_o, out in rows:
            above = lo is None or (u is not None and (u > lo if lo_o else u >= lo))
            below = hi is None or (u is not None and (u < hi if hi_o else u <= hi))
            if se in (None, s) and te in (None, t_) and above and below:
                yield n, out

    per_key = {}
    for fact in facts:
        per_key.setdefault(fact[0], []).extend(hits(fact))
    got = {}
    for r in found.collect():
        had = got.get(r.k, (0, (1 << 30, "")))
        got[r.k] = (had[0] + r["__n"], min(had[1], (r.row_no, r.out)))
    assert got == {k: (len(v), min(v)) for k, v in per_key.items() if v}
    policies = {r.k: (r.n_hits, r.first_row, r.first) for r in rule_tables.hit_policies(f, found, "k", "out").collect()}
    assert all(policies[k] == (len(v), *(min(v) if v else (None, None))) for k, v in per_key.items() if k is not None)
    # Rows of one number, whatever holds: pairs are never made.
    everywhere = t.selectExpr("row_no", "null s_eq", "null t_eq", "-1e9D u_lo", "cast(null as double) u_hi",
                              "false u_lo_open", "false u_hi_open", "out").withColumns({
                                  "s_eq": F.lit(None).cast("string"), "t_eq": F.lit(None).cast("string")})
    few = rule_tables.matches(f, everywhere, "k", ["s", "t"], ["u"], "out", counted=True)
    assert few.count() < 2 * len(facts)  # of 290 times 400 pairs
    assert few.agg(F.sum("__n")).first()[0] == 400 * f.where("u is not null").count()
    assert rule_tables.matches(f.limit(0), t, "k", ["s", "t"], ["u"], "out", counted=True).count() == 0
    assert rule_tables.matches(f, t.limit(0), "k", ["s", "t"], ["u"], "out", counted=True).count() == 0
