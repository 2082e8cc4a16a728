"""The rule model: what a pack declares. Expressions are Spark SQL over the loan columns.

A pack is metadata of bounded size, written by people; the loans it is evaluated on are data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import types as T

# The types a vocabulary may use, the verdict names, the default window pad.
FIELD_TYPES = ("date", "enum", "boolean", "number", "string", "date_list")
DERIVED_TYPES = ("date", "day_set", "number", "boolean")
PASS, FAIL, NOT_APPLICABLE = "pass", "fail", "not_applicable"
PAD_DAYS = 10

SPARK_TYPES = {
    "date": T.DateType(),
    "enum": T.StringType(),
    "boolean": T.BooleanType(),
    "number": T.DoubleType(),
    "string": T.StringType(),
    "date_list": T.ArrayType(T.DateType()),
    "day_set": T.ArrayType(T.DateType()),
}


class VocabularyError(ValueError):
    """A vocabulary that cannot describe a loan file."""


@dataclass(frozen=True)
class DaySet:
    """A derived list of days: a padded window without one weekday (Monday 1 to Sunday 7) and
    without a list of days; `test` is an extra test of one `day`, where a rule needs one."""

    name: str
    start: str
    end: str
    pad_days: int = PAD_DAYS
    closed_weekday: int | None = None
    excluded: str | None = None
    test: str | None = None
    source_rule: str | None = None

    @property
    def text(self) -> str:
        return " ".join(t for t in (self.start, self.end, self.test, self.excluded) if t)


@dataclass(frozen=True)
class Derived:
    """A derived scalar: one Spark SQL expression."""

    name: str
    expression: str
    source_rule: str | None = None

    @property
    def text(self) -> str:
        return self.expression


@dataclass(frozen=True)
class Rule:
    """When `applies_when` is true, `requirement` decides pass or fail. Null decides neither."""

    rule_id: str
    subsection: str
    applies_when: str
    requirement: str


@dataclass(frozen=True)
class Pack:
    derived: tuple[DaySet | Derived, ...]
    rules: tuple[Rule, ...]

    def in_order(self) -> list[DaySet | Derived]:
        """The derived fields so that each comes after those it reads."""
        by_name = {d.name: d for d in self.derived}
        reads = {
            d.name: {o for o in by_name if o != d.name and re.search(rf"\bderived\.{o}\b", d.text)}
            for d in self.derived
        }
        return [by_name[n] for n in TopologicalSorter(reads).static_order()]


@dataclass(frozen=True)
class Vocabulary:
    """The closed list of what a loan file holds and what a rule may name."""

    fields: dict[str, str]
    labels: dict[str, str] = field(default_factory=dict)
    enums: dict[str, dict[str, str]] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)
    windows: dict[str, dict] = field(default_factory=dict)
    functions: tuple[str, ...] = ()
    methods: tuple[str, ...] = ()
    encodings: dict[int, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name, kind in self.fields.items():
            if kind not in FIELD_TYPES:
                raise VocabularyError(f"{name}: {kind} is not one of {FIELD_TYPES}")
            if kind == "enum" and not self.enums.get(name):
                raise VocabularyError(f"{name}: an enum lists its values")
        for name, kind in self.derived.items():
            if kind not in DERIVED_TYPES:
                raise VocabularyError(f"{name}: {kind} is not one of {DERIVED_TYPES}")
            if kind == "day_set":
                window = self.windows.get(name) or {}
                if not {"from", "to", "pad_days"} <= window.keys():
                    raise VocabularyError(f"{name}: a day set has a window with from, to, pad_days")
                ends = [window["from"], window["to"]]
                if any(self.fields.get(e) != "date" for e in ends):
                    raise VocabularyError(f"{name}: the window runs between two date fields")

    def schema(self) -> T.StructType:
        """The dotted field names as one nested schema."""
        tree: dict = {}
        for name, kind in self.fields.items():
            *parents, leaf = name.split(".")
            node = tree
            for p in parents:
                node = node.setdefault(p, {})
            node[leaf] = SPARK_TYPES[kind]
        return _struct(tree)


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(k, _struct(v) if isinstance(v, dict) else v) for k, v in tree.items()]
    )


# The loan-file vocabulary.
LOAN_VOCABULARY = Vocabulary(
    fields={
        "cd.issue_date": "date",
        "cd.delivery_method": "enum",
        "cd.received_date": "date",
        "cd.mailed_date": "date",
        "closing_date": "date",
        "transaction.timeshare": "boolean",
        "note.amount": "number",
        "cd.amount": "number",
        "ltv": "number",
        "flood_zone": "string",
        "calendar.holidays": "date_list",
    },
    labels={
        "cd.issue_date": "date the Closing Disclosure was issued",
        "cd.delivery_method": "how the Closing Disclosure was provided",
        "cd.received_date": "date the consumer received the Closing Disclosure, as recorded in the loan file",
        "cd.mailed_date": "date the Closing Disclosure was delivered other than in person, or placed in the mail",
        "closing_date": "date of consummation",
        "transaction.timeshare": "the transaction is secured by a consumer's interest in a timeshare plan",
        "note.amount": "loan amount on the note",
        "cd.amount": "loan amount on the Closing Disclosure",
        "ltv": "loan-to-value ratio, in percent",
        "flood_zone": "FEMA flood zone designation of the property",
        "calendar.holidays": "legal public holidays (5 U.S.C. 6103(a)) as observed, supplied with the loan file",
        "derived.business_days": "business days",
        "derived.cd_receipt_date": "date the consumer received, or is considered to have received, the Closing Disclosure",
    },
    enums={
        "cd.delivery_method": {
            "in_person": "handed to the consumer in person",
            "mail": "placed in the mail",
            "electronic": "delivered electronically",
        }
    },
    derived={"derived.business_days": "day_set", "derived.cd_receipt_date": "date"},
    windows={
        "derived.business_days": {"from": "cd.issue_date", "to": "closing_date", "pad_days": PAD_DAYS}
    },
    functions=("d", "count", "filter", "contains", "len"),
    methods=(
        "weekday", "add", "sub", "diff", "format",
        "isBefore", "isAfter", "isSame", "isSameOrBefore", "isSameOrAfter",
    ),
    encodings={7: "Sunday"},
)

# The rule ids and paragraph labels of the timing rules.
BUSINESS_DAYS_RULE = "1026.2(a)(6).s2/d1"
RECEIPT_RULE = "1026.19(f)(1)(iii)/d1"
GENERAL_RULE = "1026.19(f)(1)(ii)(A)/r1"
TIMESHARE_RULE = "1026.19(f)(1)(ii)(B)/r1"
GENERAL_PARAGRAPH = "1026.19(f)(1)(ii)(A)"
TIMESHARE_PARAGRAPH = "1026.19(f)(1)(ii)(B)"


def timing_pack() -> Pack:
    """The disclosure-timing rules.

    Scope, as in the rules' sentences: the (f)(2) exceptions are not decided here, and the
    receipt date of a mailed disclosure is the presumed one also when it came earlier.
    """
    return Pack(
        derived=(
            DaySet(
                name="business_days",
                start="cd.issue_date",
                end="closing_date",
                closed_weekday=7,
                excluded="calendar.holidays",
                source_rule=BUSINESS_DAYS_RULE,
            ),
            Derived(
                name="cd_receipt_date",
                expression=(
                    "case when cd.delivery_method = 'in_person' then cd.received_date"
                    " else get(filter(derived.business_days, day -> day > cd.mailed_date), 2) end"
                ),
                source_rule=RECEIPT_RULE,
            ),
        ),
        rules=(
            Rule(
                rule_id=GENERAL_RULE,
                subsection=GENERAL_PARAGRAPH,
                applies_when="not transaction.timeshare",
                requirement=(
                    "size(filter(derived.business_days,"
                    " day -> day >= derived.cd_receipt_date and day < closing_date)) >= 3"
                ),
            ),
            Rule(
                rule_id=TIMESHARE_RULE,
                subsection=TIMESHARE_PARAGRAPH,
                applies_when="transaction.timeshare",
                requirement="derived.cd_receipt_date <= closing_date",
            ),
        ),
    )
