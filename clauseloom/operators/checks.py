"""Test cases of a pack: what each expects, what came out, which rules they leave untested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseloom.model import NOT_APPLICABLE, DaySet, Pack
from clauseloom.operators.rules import decision_rows, paragraphs, verdict, with_decisions
from clauseloom.operators.rows import catalogue, value_rows

# What a test case expects: a result, or a value, or days.
EXPECTED = "struct<result:string,value:string,includes:array<date>,excludes:array<date>>"


def decided_tests(tests: DataFrame, pack: Pack) -> DataFrame:
    """Test cases with what the pack gives for their input: `own_result` (of the case's rule),
    `paragraph_verdict` (of its paragraph), both null when nothing fires, and `derived`.

    A test case is a loan with columns test_id, rule_id, subsection, field and `expected`.
    """
    keep = ("test_id", "rule_id", "subsection", "field", "expected")
    cells = with_decisions(tests, pack, keep)
    results = [verdict(F.col(f"applies_{i}"), F.col(f"met_{i}")) for i in range(len(pack.rules))]
    named = cells.select(*keep, "derived", *[r.alias(f"result_{i}") for i, r in enumerate(results)])
    own = [
        F.when(F.col("rule_id") == r.rule_id, F.col(f"result_{i}"))
        for i, r in enumerate(pack.rules)
    ]
    # `fail` sorts before `pass`: the least of a paragraph's results is its fold.
    folds = []
    for p in paragraphs(pack):
        members = [F.col(f"result_{i}") for i, r in enumerate(pack.rules) if r.subsection == p]
        least = F.least(*members) if len(members) > 1 else members[0]
        folds.append(F.when(F.col("subsection") == p, least))
    return named.withColumns(
        {"own_result": F.coalesce(*own), "paragraph_verdict": F.coalesce(*folds)}
    )


def test_failures(tests: DataFrame, pack: Pack) -> DataFrame:
    """(test_id, problem) for each case that does not hold. Row-wise."""
    return value_rows(decided_tests(tests, pack), ["test_id"], "problem", _problem(pack))


def _problem(pack: Pack) -> Column:
    wanted = F.col("expected.result")
    got = F.coalesce("own_result", F.lit(NOT_APPLICABLE))
    known = F.col("rule_id").isin([r.rule_id for r in pack.rules])
    by_rule = F.when(~known, F.concat(F.lit("no such rule: "), "rule_id")).when(
        got != wanted, F.concat(F.lit("expected "), wanted, F.lit(", got "), got)
    )
    by_paragraph = F.when(
        F.col("paragraph_verdict").isNotNull(),
        F.concat(
            F.lit("expected no rule of "), "subsection", F.lit(" to apply, got "), "paragraph_verdict"
        ),
    )
    sets = [s.name for s in pack.derived if isinstance(s, DaySet)]
    scalars = [s.name for s in pack.derived if not isinstance(s, DaySet)]

    def chosen(names: list[str], kind: str) -> Column:
        """The derived value the case is about."""
        picks = [F.when(F.col("field") == f"derived.{n}", F.col(f"derived.{n}").cast(kind)) for n in names]
        return F.coalesce(*picks, F.lit(None).cast(kind))

    none = F.expr("cast(array() as array<date>)")
    days = F.coalesce(chosen(sets, "array<date>"), none)
    missing = F.size(F.array_except(F.coalesce("expected.includes", none), days))
    extra = F.size(F.array_intersect(F.coalesce("expected.excludes", none), days))
    by_days = F.when(
        missing + extra > 0,
        F.concat(
            F.col("field"), F.lit(": missing "), missing.cast("string"),
            F.lit(", not to contain "), extra.cast("string"),
        ),
    )
    value = chosen(scalars, "string")
    by_value = F.when(
        ~value.eqNullSafe(F.col("expected.value")),
        F.concat(
            F.col("field"), F.lit(": expected "), F.coalesce("expected.value", F.lit("nothing")),
            F.lit(", got "), F.coalesce(value, F.lit("nothing")),
        ),
    )
    return (
        F.when(wanted.isNotNull() & F.col("rule_id").isNull(), by_paragraph)
        .when(wanted.isNotNull(), by_rule)
        .when(F.col("field").isin([f"derived.{n}" for n in sets]), by_days)
        .otherwise(by_value)
    )


def rules_under_test(tests: DataFrame, rules: DataFrame) -> DataFrame:
    """(test_id, rule_id): a test's own rule, or every rule of a fixture's subsection. A test of
    a derived field exercises no rule.

    `rules` (rule_id, subsection) is a catalogue. A fixture has a subsection, and then its own
    rule does not count apart from the others.
    """
    own = tests.where(F.col("subsection").isNull() & F.col("result").isNotNull()).select(
        "test_id", "rule_id"
    )
    by_paragraph = tests.where(F.col("subsection").isNotNull()).select("test_id", "subsection").join(
        catalogue(rules.select("rule_id", "subsection")), "subsection"
    ).select("test_id", "rule_id")
    return own.unionByName(by_paragraph)


def coverage_gaps(tests: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_id, gap): rules without a passing and a failing case, derived fields without two
    different expectations.

    `tests` has (rule_id, expectation), `rules` (rule_id, kind). Minimum, maximum and two flags
    say it all, and they combine before the shuffle: no set of expectations is ever collected.
    """
    seen = tests.groupBy("rule_id").agg(
        F.max((F.col("expectation") == "pass").cast("int")).alias("has_pass"),
        F.max((F.col("expectation") == "fail").cast("int")).alias("has_fail"),
        F.min("expectation").alias("least"),
        F.max("expectation").alias("greatest"),
    )
    gap = F.when(
        (F.col("kind") == "rule")
        & ~(F.coalesce("has_pass", F.lit(0)) + F.coalesce("has_fail", F.lit(0)) == 2),
        "needs a passing and a failing case",
    ).when(
        (F.col("kind") == "derived_field")
        & F.coalesce(F.col("least") == F.col("greatest"), F.lit(True)),
        "needs two cases with different values",
    )
    joined = rules.select("rule_id", "kind").join(seen, "rule_id", "left")
    return value_rows(joined, ["rule_id"], "gap", gap)


def disagreements(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that two formulations do not both have, as often: the columns of both plus `side`
    and `times`. Both directions in one shuffle: rows count +1 and -1, sums combine before it."""
    columns = one.columns
    signed = one.select(*columns, F.lit(1).alias("sign")).unionByName(
        other.select(*columns, F.lit(-1).alias("sign"))
    )
    balance = signed.groupBy(*columns).agg(F.sum("sign").alias("balance"))
    return balance.where(F.col("balance") != 0).select(
        *columns,
        F.when(F.col("balance") > 0, "one").otherwise("other").alias("side"),
        F.abs("balance").alias("times"),
    )


def test_run(tests: DataFrame, pack: Pack, rules: DataFrame) -> DataFrame:
    """Every finding over all test cases: (check, subject, detail)."""
    failures = test_failures(tests, pack).select(
        F.lit("test").alias("check"), F.col("test_id").alias("subject"), F.col("problem").alias("detail")
    )
    keep = ("test_id", "rule_under_test", "subsection_under_test", "has_result")
    slim = tests.select(
        "*",
        F.col("rule_id").alias("rule_under_test"),
        F.col("subsection").alias("subsection_under_test"),
        F.col("expected.result").isNotNull().alias("has_result"),
    )
    paragraph_of = F.create_map(*[F.lit(x) for r in pack.rules for x in (r.rule_id, r.subsection)])
    cells = decision_rows(with_decisions(slim, pack, keep), pack, keep)
    exercised = F.when(
        F.col("subsection_under_test").isNotNull(),
        paragraph_of[F.col("rule_id")] == F.col("subsection_under_test"),
    ).otherwise(F.col("has_result") & (F.col("rule_id") == F.col("rule_under_test")))
    gap_cells = value_rows(
        cells.where(exercised),
        ["test_id", "rule_id"],
        "cell",
        F.when(F.col("applies").isNull(), "applies_when"),
        F.when(F.col("met").isNull(), "requirement"),
    )
    undecided = gap_cells.select(
        F.lit("cell").alias("check"),
        F.col("test_id").alias("subject"),
        F.concat("rule_id", F.lit(" "), "cell", F.lit(" does not decide")).alias("detail"),
    )
    expectations = tests.where(F.col("rule_id").isNotNull()).select(
        "rule_id", F.coalesce("expected.result", F.to_json("expected")).alias("expectation")
    )
    gaps = coverage_gaps(expectations, rules).select(
        F.lit("coverage").alias("check"), F.col("rule_id").alias("subject"), F.col("gap").alias("detail")
    )
    subject = F.col("subject").cast("string").alias("subject")
    return (
        failures.select("check", subject, "detail")
        .unionByName(undecided.select("check", subject, "detail"))
        .unionByName(gaps.select("check", subject, "detail"))
    )


# Test functions of a library, not of a test suite.
test_failures.__test__ = False
test_run.__test__ = False

__all__ = [
    "coverage_gaps", "decided_tests", "disagreements", "rules_under_test",
    "test_failures", "test_run",
]
