"""The published cases: eleven of the rules, five whole loan files."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clauseloom import timing_pack
from clauseloom.model import (
    BUSINESS_DAYS_RULE,
    GENERAL_PARAGRAPH,
    GENERAL_RULE,
    RECEIPT_RULE,
    TIMESHARE_PARAGRAPH,
    TIMESHARE_RULE,
)
from clauseloom.operators import checks, rules

ONE = ["2026-10-12"]
FULL = ["2026-10-12", "2026-11-11", "2026-11-26", "2026-12-25"]
YES, NO, MISSING = True, False, None

# name, rule, paragraph (whole loan files only), issue, method, received, mailed, closing,
# timeshare, holidays, expected
CASES = [
    ("A-1", GENERAL_RULE, None, "10-14", "in_person", "10-15", None, "10-19", NO, ONE, "pass"),
    ("A-2", GENERAL_RULE, None, "10-14", "in_person", "10-16", None, "10-19", NO, ONE, "fail"),
    ("A-3", GENERAL_RULE, None, "10-14", "in_person", "10-16", None, "10-19", YES, ONE, "not_applicable"),
    ("B-1", TIMESHARE_RULE, None, "10-14", "in_person", "10-19", None, "10-19", YES, ONE, "pass"),
    ("B-2", TIMESHARE_RULE, None, "10-14", "mail", None, "10-16", "10-19", YES, ONE, "fail"),
    ("B-3", TIMESHARE_RULE, None, "10-14", "in_person", "10-20", None, "10-19", NO, ONE, "not_applicable"),
    ("iii-1", RECEIPT_RULE, None, "10-14", "in_person", "10-15", None, "10-19", MISSING, ONE, "10-15"),
    ("iii-2", RECEIPT_RULE, None, "10-20", "mail", None, "10-20", "10-26", MISSING, ONE, "10-23"),
    ("iii-3", RECEIPT_RULE, None, "10-09", "electronic", None, "10-09", "10-19", MISSING, ONE, "10-14"),
    ("s2-1", BUSINESS_DAYS_RULE, None, "10-09", None, None, None, "10-14", MISSING, ONE,
     (["10-09", "10-10", "10-13", "10-14"], ["10-11", "10-12"])),
    ("s2-2", BUSINESS_DAYS_RULE, None, "10-09", None, None, None, "10-14", MISSING, [],
     (["10-10", "10-12"], ["10-11"])),
    ("mailed Tuesday", GENERAL_RULE, GENERAL_PARAGRAPH, "10-20", "mail", None, "10-20", "10-22", NO, FULL, "fail"),
    ("received Friday", GENERAL_RULE, GENERAL_PARAGRAPH, "10-14", "in_person", "10-16", None, "10-19", NO, FULL, "fail"),
    ("received Saturday", GENERAL_RULE, GENERAL_PARAGRAPH, "10-09", "in_person", "10-10", None, "10-14", NO, FULL, "fail"),
    ("received Thursday", GENERAL_RULE, GENERAL_PARAGRAPH, "10-14", "in_person", "10-15", None, "10-19", NO, FULL, "pass"),
    ("timeshare", TIMESHARE_RULE, TIMESHARE_PARAGRAPH, "10-14", "in_person", "10-16", None, "10-19", YES, FULL, "pass"),
]

SCHEMA = (
    "test_id string, rule_id string, subsection string, field string,"
    f" expected {checks.EXPECTED}, cd struct<issue_date:date,delivery_method:string,"
    "received_date:date,mailed_date:date>, closing_date date,"
    " transaction struct<timeshare:boolean>, calendar struct<holidays:array<date>>"
)
FIELD = {RECEIPT_RULE: "derived.cd_receipt_date", BUSINESS_DAYS_RULE: "derived.business_days"}


def day(text):
    return None if text is None else date.fromisoformat(f"2026-{text}")


def expectation(rule, wanted):
    if rule == RECEIPT_RULE:
        return (None, f"2026-{wanted}", None, None)
    if rule == BUSINESS_DAYS_RULE:
        return (None, None, [day(d) for d in wanted[0]], [day(d) for d in wanted[1]])
    return (wanted, None, None, None)


@pytest.fixture(scope="module")
def cases(spark):
    rows = [
        (
            name, rule, paragraph, FIELD.get(rule), expectation(rule, wanted),
            (day(issue), method, day(received), day(mailed)), day(closing), (timeshare,),
            ([date.fromisoformat(h) for h in holidays],),
        )
        for name, rule, paragraph, issue, method, received, mailed, closing, timeshare, holidays, wanted in CASES
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_all_cases_hold(cases):
    assert checks.test_failures(cases, timing_pack()).collect() == []


def test_a_wrong_expectation_is_named(cases):
    swap = F.when(F.col("expected.result") == "pass", "fail").otherwise(F.col("expected.result"))
    wrong = cases.withColumn("expected", F.col("expected").withField("result", swap))
    problems = {r.test_id: r.problem for r in checks.test_failures(wrong, timing_pack()).collect()}
    assert problems == {n: "expected fail, got pass" for n in ("A-1", "B-1", "received Thursday", "timeshare")}


def test_days_missing_and_extra_are_counted(spark, cases):
    other = cases.where("test_id = 's2-1'").withColumn(
        "expected", F.col("expected").withField("includes", F.array(F.lit("2026-10-11").cast("date")))
        .withField("excludes", F.array(F.lit("2026-10-13").cast("date")))
    )
    assert [r.problem for r in checks.test_failures(other, timing_pack()).collect()] == [
        "derived.business_days: missing 1, not to contain 1"
    ]


def test_a_paragraph_that_should_not_apply(spark, cases):
    other = cases.where("test_id = 'timeshare'").withColumn("rule_id", F.lit(None).cast("string"))
    assert [r.problem for r in checks.test_failures(other, timing_pack()).collect()] == [
        f"expected no rule of {TIMESHARE_PARAGRAPH} to apply, got pass"
    ]


def test_run_is_clean_and_covered(spark, cases):
    kinds = [(GENERAL_RULE, "rule"), (TIMESHARE_RULE, "rule"),
             (RECEIPT_RULE, "derived_field"), (BUSINESS_DAYS_RULE, "derived_field")]
    catalogue = spark.createDataFrame(kinds, "rule_id string, kind string")
    assert checks.test_run(cases, timing_pack(), catalogue).collect() == []
    few = cases.where("test_id <> 'B-2'")
    found = checks.test_run(few, timing_pack(), catalogue).collect()
    assert [(r.check, r.subject) for r in found] == [("coverage", TIMESHARE_RULE)]


def test_rules_under_test(spark, cases):
    slim = cases.select("test_id", "rule_id", "subsection", F.col("expected.result").alias("result"))
    pairs = checks.rules_under_test(slim, rules.rules_frame(spark, timing_pack())).collect()
    assert len(pairs) == 11
    assert {r.rule_id for r in pairs} == {GENERAL_RULE, TIMESHARE_RULE}


def test_window_in_daylight_saving_zones(spark, cases):
    """Dates are dates: the session's zone has no say, also where clocks change in the window."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Paris", "Asia/Jerusalem"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert checks.test_failures(cases, timing_pack()).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
