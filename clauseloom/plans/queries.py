"""The registered queries: (spark, directory of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.functions import names
from clauseloom.functions.language import DATE_METHODS, EXPRESSION_FUNCTIONS, FEEL_FUNCTIONS
from clauseloom.model import (
    GENERAL_PARAGRAPH,
    GENERAL_RULE,
    RECEIPT_RULE,
    TIMESHARE_PARAGRAPH,
    TIMESHARE_RULE,
    Derived,
    Pack,
    timing_pack,
)
from clauseloom.operators import (
    blocking,
    calendar,
    checks,
    conform,
    derive,
    expressions,
    gates,
    quotes,
    report,
    rule_tables,
    rules,
    sentences,
    tables,
)
from clauseloom.plans.corpus import SQL, Inputs, holiday_dates, nest_loans
from clauseloom.session import shared_path
from clauseloom.sources import loans as loan_source
from clauseloom.sources import packs
from clauseloom.sources.verdicts import write_verdicts
from clauseloom.streaming import verdicts as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Registers a plan under its function's name; an underscore at the end, which keeps it apart
    from an import, does not count."""
    QUERIES[build.__name__.rstrip("_")] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# --- sources ----------------------------------------------------------------------------------

def _raw_nested(i: Inputs) -> DataFrame:
    flat = i["raw_loans"]
    days = F.expr("array(" + ", ".join(f"'{d}'" for d in holiday_dates()) + ")")
    listed = F.when(F.col("loan_id") % 61 != 0, days)
    return nest_loans(flat, listed).withColumns(
        {"ltv": F.lit(None).cast("double"), "flood_zone": F.lit(None).cast("string")}
    )


@query
def loan_files(i: Inputs) -> DataFrame:
    raw = _raw_nested(i)
    body = raw.select("loan_id", F.to_json(F.struct(*raw.columns[1:])).alias("body"))
    loans = loan_source.parse_loans(body, "body", keep=("loan_id",))
    return loans.select(
        "loan_id",
        "cd.issue_date",
        "cd.delivery_method",
        "cd.received_date",
        "cd.mailed_date",
        "closing_date",
        "transaction.timeshare",
        F.size("calendar.holidays").alias("n_holidays"),
    )


@query
def unreadable_files(i: Inputs) -> DataFrame:
    """Files as they arrive, of loans, models and questions: some are cut off, some empty, some no object."""
    return (
        packs.unreadable(i["arrived_bodies"], "loan_id")
        .unionByName(packs.unreadable(i["arrived_models"], "name", form="xml"))
        .unionByName(packs.unreadable(i["arrived_questions"], "name", form="yaml"))
    )


@query
def conformance_report(i: Inputs) -> DataFrame:
    return conform.conform(_raw_nested(i), "loan_id")


@query
def paragraphs(i: Inputs) -> DataFrame:
    return sentences.parse_paragraphs(i["doc_lines"], "line", keep=("doc_id", "line_no")).drop("line")


@query
def duplicate_sentence_ids(i: Inputs) -> DataFrame:
    return sentences.duplicates(i["file_sentences"], "id")


@query
def source_fingerprint(i: Inputs) -> DataFrame:
    return sentences.fingerprints(i["documents"], "doc_id", "text")


@query
def nfc_violations(i: Inputs) -> DataFrame:
    return sentences.nfc_violations(i["accent_docs"], "doc_id", "text")


@query
def sentences_(i: Inputs) -> DataFrame:
    return i["doc_sentences"].select("sentence_id", "n", "text", "label", "heading")


@query
def paragraph_keys(i: Inputs) -> DataFrame:
    label, path = F.col("label"), F.col("path")
    return i["labels_of_parts"].select(
        "p_partkey",
        names.subsection_key(label).alias("subsection_key"),
        names.slug(label).alias("slug"),
        names.rule_xml_id(F.concat(label, F.lit("/r1")), F.lit("pass")).alias("rule_xml_id"),
        names.feel_name(path).alias("feel_name"),
        names.input_xml_id(path).alias("input_xml_id"),
    )


def _receipt_bodies(i: Inputs) -> DataFrame:
    """A receipts file per order, as JSON text."""
    receipt = F.struct("kind", "quote", "applies_when", "requirement")
    state = F.struct(F.lit("file").alias("source"), F.lit("RULE").alias("state"))
    key = F.col("k").cast("string")
    body = F.struct(
        F.create_map(F.col("rule_id"), receipt).alias("rules"),
        F.array(
            F.struct(
                F.concat(F.lit("s"), key).alias("sentence_id"),
                F.lit("reference").alias("kind"),
                F.col("pack").alias("target"),
                F.lit("paragraph").alias("cited_as"),
            )
        ).alias("links"),
        F.create_map(F.concat(F.lit("s"), key), state).alias("sentences"),
        F.create_map(F.col("pack"), F.struct(F.sha2("quote", 256).alias("sha256"))).alias("sources"),
    )
    return i["receipts"].select(key.alias("pack"), F.to_json(body).alias("body"))


@query
def pack_tables(i: Inputs) -> DataFrame:
    t = packs.receipt_tables(_receipt_bodies(i))

    def part(name: str, item: str, text: str) -> DataFrame:
        return t[name].select(
            "pack", F.lit(name).alias("relation"), F.col(item).alias("item"), F.col(text).alias("text")
        )

    return (
        part("receipt", "rule_id", "requirement")
        .unionByName(part("link", "target", "cited_as"))
        .unionByName(part("sentence_state", "sentence_id", "state"))
        .unionByName(part("source", "source", "sha256"))
    )


@query
def jdm_rows(i: Inputs) -> DataFrame:
    def row(result: str, requirement) -> object:
        return F.create_map(
            F.lit("_id"), F.concat("rule_id", F.lit(f"/{result}")),
            F.lit("i1"), F.col("applies_when"),
            F.lit("i2"), requirement,
            F.lit("o1"), F.concat(F.lit('"'), "rule_id", F.lit('"')),
            F.lit("o2"), F.lit(f'"{result}"'),
        )

    no_rows = F.lit(None).cast("array<map<string,string>>")
    negated = F.concat(F.lit("not ("), "requirement", F.lit(")"))
    table = F.array(row("pass", F.col("requirement")), row("fail", negated))

    def node(name: str, kind: str, content_rows) -> object:
        content = F.struct(F.lit("collect").alias("hitPolicy"), content_rows.alias("rules"))
        return F.struct(
            F.lit(name).alias("id"), F.lit(kind).alias("type"), F.lit(name).alias("name"),
            content.alias("content"),
        )

    body = F.struct(
        F.array(
            node("input", "inputNode", no_rows), node("table", "decisionTableNode", table)
        ).alias("nodes")
    )
    models = i["receipts"].where("kind = 'rule'").select(
        F.col("k").cast("string").alias("pack"), F.to_json(body).alias("body")
    )
    return packs.model_tables(models)["row"].select(
        "pack", "node_id", "hit_policy", "row_id", "i1", "i2", "rule_id", "result"
    )


@query
def dmn_rules(i: Inputs) -> DataFrame:
    def escaped(col):
        for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            col = F.replace(col, F.lit(mark), F.lit(entity))
        return col

    rule_key = names.slug(F.col("rule_id"))
    when = F.when(F.col("applies_when") == "", "-").otherwise(escaped(F.col("applies_when")))

    def rule(result: str, requirement) -> list:
        return [
            F.lit('<rule id="rule_'), rule_key, F.lit(f'_{result}"><description>'), F.col("rule_id"),
            F.lit(f"/{result}</description><inputEntry><text>"), when,
            F.lit("</text></inputEntry><inputEntry><text>"), requirement,
            F.lit('</text></inputEntry><outputEntry><text>"'), F.col("rule_id"),
            F.lit(f'"</text></outputEntry><outputEntry><text>"{result}"</text></outputEntry></rule>'),
        ]

    feel = escaped(F.col("feel"))
    body = F.concat(
        F.lit('<definitions xmlns="https://www.omg.org/spec/DMN/20191111/MODEL/"><decision id="s'),
        rule_key, F.lit('" name="d"><decisionTable id="t" hitPolicy="COLLECT">'),
        *rule("pass", feel),
        *rule("fail", F.concat(F.lit("(not("), feel, F.lit("))"))),
        F.lit("</decisionTable></decision></definitions>"),
    )
    models = i["receipts"].where("kind = 'rule'").select(
        F.col("k").cast("string").alias("pack"), body.alias("body")
    )
    return packs.dmn_tables(models)["rule"].select(
        "pack", "decision", "xml_id", "description", "applies_when", "requirement", "rule_id", "result"
    )


@query
def questions_answers(i: Inputs) -> DataFrame:
    """A questions file per customer, an answer in it for some."""
    key = F.col("c_custkey").cast("string")
    body = F.concat(
        F.lit("questions:\n- id: q"), key, F.lit("\n  sentence_id: s"), key,
        F.lit("\n  issue: "), F.col("c_mktsegment"),
        F.lit("\n  readings:\n  - id: a\n    reading: first\n  - id: b\n    reading: second\nanswers: "),
        F.when(
            F.col("c_custkey") % 4 != 0,
            F.concat(
                F.lit("\n- question_id: q"), key, F.lit("\n  sentence_id: s"), key,
                F.lit("\n  reading: chosen\n  reading_id: "),
                F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b"),
            ),
        ).otherwise("[]"),
        F.lit("\n"),
    )
    rows = packs.question_rows(i["customer"].select(key.alias("pack"), body.alias("body")))
    # A file holds its own answers, so the pair meets by grouping once, not by a join of two reads.
    tagged = rows.where("part in ('question', 'answer')").groupBy(F.col("id").alias("question_id")).agg(
        F.max(F.when(F.col("part") == "question", F.col("sentence_id"))).alias("sentence_id"),
        F.max(F.when(F.col("part") == "question", F.col("text"))).alias("issue"),
        F.max(F.when(F.col("part") == "answer", F.col("reading_id"))).alias("reading_id"),
    )
    return tagged.withColumn("open", F.col("reading_id").isNull())


@query
def open_questions(i: Inputs) -> DataFrame:
    return gates.open_questions(i["questions"], i["answers"])


@query
def write_verdicts_(i: Inputs) -> DataFrame:
    path = shared_path(i.spark, "verdicts")
    write_verdicts(rules.evaluate(i.loans(), timing_pack()), path)
    return i.spark.read.parquet(path).select("loan_id", "rule_id", "result")


# --- derivations ------------------------------------------------------------------------------

@query
def day_window(i: Inputs) -> DataFrame:
    days = F.col("window")
    return derive.day_windows(i.loans()).select(
        "loan_id",
        F.size(days).alias("n_days"),
        F.array_min(days).alias("first_day"),
        F.array_max(days).alias("last_day"),
    )


@query
def business_days(i: Inputs) -> DataFrame:
    return derive.business_day_sets(i.loans()).select(
        "loan_id",
        F.size("days").alias("n_days"),
        F.array_join(F.col("days").cast("array<string>"), ",").alias("days"),
    )


@query
def nth_business_day_after(i: Inputs) -> DataFrame:
    from clauseloom.functions.dates import nth_day_after

    loans = i.loans().withColumn("days", derive.business_days())
    return loans.select(
        "loan_id",
        *[
            nth_day_after(F.col("days"), F.col("cd.issue_date"), n).alias(f"day_{n}")
            for n in (1, 3, 25)
        ],
    )


@query
def receipt_date(i: Inputs) -> DataFrame:
    return derive.receipt_dates(i.loans()).select("loan_id", "cd_receipt_date")


@query
def business_days_between(i: Inputs) -> DataFrame:
    return derive.days_before_closing(i.loans())


@query
def calendar_dim(i: Inputs) -> DataFrame:
    """Calendars named by the first day of their list, as the lists come in two orders."""
    dim = calendar.calendar_dim(calendar.holiday_lists(i.loans()))
    return dim.select(F.get("holidays", F.lit(0)).alias("calendar"), "day", "is_business", "n_before")


@query
def calendar_verdicts(i: Inputs) -> DataFrame:
    return calendar.evaluate_by_calendar(i.loans(), timing_pack())


@query
def derived_struct(i: Inputs) -> DataFrame:
    loans = rules.with_derived(i.loans(), timing_pack())
    return loans.select(
        "loan_id",
        F.size("derived.business_days").alias("n_business_days"),
        "derived.cd_receipt_date",
        F.col("cd.issue_date").alias("issue_date"),
    )


@query
def evaluation_order(i: Inputs) -> DataFrame:
    """Fields declared in the wrong order, each reading an earlier one, come out the same."""
    pack = timing_pack()
    late = Derived("slack", "datediff(closing_date, derived.cd_receipt_date)")
    shuffled = Pack((late, *reversed(pack.derived)), pack.rules)
    loans = rules.with_derived(i.loans(), shuffled)
    return loans.select("loan_id", "derived.cd_receipt_date", "derived.slack")


# --- rules ------------------------------------------------------------------------------------

@query
def rule_verdicts(i: Inputs) -> DataFrame:
    return rules.evaluate(i.loans(), timing_pack())


def _one_rule(i: Inputs, rule_id: str) -> DataFrame:
    pack = timing_pack()
    return rules.evaluate(i.loans(), Pack(pack.derived, tuple(r for r in pack.rules if r.rule_id == rule_id)))


@query
def timing_rule_general(i: Inputs) -> DataFrame:
    return _one_rule(i, GENERAL_RULE)


@query
def timing_rule_timeshare(i: Inputs) -> DataFrame:
    return _one_rule(i, TIMESHARE_RULE)


@query
def collect_hits(i: Inputs) -> DataFrame:
    hits = rules.collect_hits(i.loans(), timing_pack())
    return hits.select(
        "loan_id",
        "subsection",
        F.size("hits").alias("n_hits"),
        F.array_join(F.col("hits.result"), ",").alias("results"),
    )


@query
def subsection_verdict(i: Inputs) -> DataFrame:
    return rules.subsection_verdicts(i.loans(), timing_pack())


@query
def subsection_verdict_rows(i: Inputs) -> DataFrame:
    loans, pack = i.loans(), timing_pack()
    return rules.fold_verdict_rows(loans, rules.evaluate(loans, pack), pack)


@query
def missing_flag_semantics(i: Inputs) -> DataFrame:
    """Per loan without a timeshare flag, how many rows fire: none, on either side of the flag."""
    pack = timing_pack()
    loans = i.loans().where(F.col("transaction.timeshare").isNull())
    hits = rules.collect_hits(loans, pack)
    return hits.groupBy("loan_id").agg(F.sum(F.size("hits")).alias("n_rows"))


@query
def undecided_cells(i: Inputs) -> DataFrame:
    return rules.undecided(i.loans(), timing_pack())


@query
def missing_receipt(i: Inputs) -> DataFrame:
    return rules.missing_receipt(i.loans(), timing_pack())


@query
def result_document(i: Inputs) -> DataFrame:
    return rules.result_document(i.loans(), timing_pack())


@query
def verdict_summary(i: Inputs) -> DataFrame:
    return rules.verdict_summary(i.loans(), timing_pack())


# The discount table: first match wins, the last row takes the rest.
DISCOUNTS = (
    {"tier": '"AUTOMOBILE"', "total": ">= 300000", "discount": 0.15},
    {"tier": '"AUTOMOBILE"', "total": ">= 100000", "discount": 0.1},
    {"tier": '"BUILDING"', "total": "> 250000", "discount": 0.12},
    {"tier": "-", "total": ">= 400000", "discount": 0.05},
    {"tier": "", "total": "", "discount": 0.0},
)
# The price table, with a third row that overlaps the second.
PRICES = (
    {"total": "< 100000", "price": "STANDARD"},
    {"total": ">= 100000", "price": "PREMIUM"},
    {"total": ">= 450000", "price": "EXCLUSIVE"},
)


@query
def first_hit(i: Inputs) -> DataFrame:
    facts = i["facts"]
    out = tables.first_hit(facts, {"tier": "tier", "total": "total"}, DISCOUNTS, "discount", "discount")
    return out.select("fact_id", "discount")


@query
def unique_hit(i: Inputs) -> DataFrame:
    out = tables.unique_hit(i["facts"], {"total": "total"}, PRICES, "price", "price")
    return out.select("fact_id", "n_hits", "violation", "price")


@query
def field_cells(i: Inputs) -> DataFrame:
    """Per fact, the discount rows whose cells hold, by position."""
    inputs = {"tier": "tier", "total": "total"}
    rows = [{**r, "row": str(n)} for n, r in enumerate(DISCOUNTS, start=1)]
    out = tables.collect_rows(i["facts"], inputs, rows, "row", "rows")
    return out.select("fact_id", F.array_join("rows", ",").alias("rows"))


@query
def decision_tables_as_data(i: Inputs) -> DataFrame:
    """The hit policies first and unique of a table with a row per order line."""
    facts = i["facts"]
    found = rule_tables.matches(facts, i["table_rows"], "fact_id", ["tier"], ["total"], "price", counted=True)
    return rule_tables.hit_policies(facts, found, "fact_id", "price")


@query
def rule_functions(i: Inputs) -> DataFrame:
    """The calls a rule may make, on order dates, through the language table."""
    orders = i["orders"].select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("d"),
        F.expr("cast(o_orderdate as date) + cast(o_orderkey % 9 - 4 as int)").alias("e"),
        F.expr("array(o_orderkey % 7, o_orderkey % 5, 3)").alias("xs"),
    )

    def method(name: str, *args: str) -> str:
        return DATE_METHODS[name].format(*args)

    def call(name: str, *args: str) -> str:
        return EXPRESSION_FUNCTIONS[name].format(*args)

    return orders.selectExpr(
        "o_orderkey",
        f"{method('weekday', 'd')} as weekday",
        f"{method('add', 'd', '3')} as added",
        f"{method('sub', 'd', '3')} as subtracted",
        f"{method('diff', 'e', 'd')} as diff",
        f"{method('format', 'd')} as formatted",
        f"{method('isBefore', 'd', 'e')} as before",
        f"{method('isAfter', 'd', 'e')} as after",
        f"{method('isSame', 'd', 'e')} as same",
        f"{method('isSameOrBefore', 'd', 'e')} as same_or_before",
        f"{method('isSameOrAfter', 'd', 'e')} as same_or_after",
        f"{call('d', 'cast(d as string)')} as parsed",
        f"{call('count', 'xs', 'x >= 3')} as counted",
        f"{call('len', call('filter', 'xs', 'x > 3'))} as filtered",
        f"{call('contains', 'xs', 'o_orderkey % 4')} as contained",
        f"{FEEL_FUNCTIONS['day of week'].format('d')} as day_name",
    )


# --- gates ------------------------------------------------------------------------------------

def _quotes_of(i: Inputs, table: DataFrame) -> DataFrame:
    return i.spark.sql(SQL["quotes"], doc_sentences=table)


@query
def quote_missing(i: Inputs) -> DataFrame:
    table = i.stored("doc_sentences")
    return gates.quote_missing(_quotes_of(i, table), table)


@query
def source_drift(i: Inputs) -> DataFrame:
    """Receipts recorded the hash of the text they were taken from; some of an older text."""
    texts = i["documents"].select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source"), "text"
    )
    now = sentences.fingerprints(texts, "source", "text")
    older = sentences.fingerprints(
        texts.select("source", F.concat("text", F.lit(" (older)")).alias("text")), "source", "text"
    )
    known = now.join(older.withColumnRenamed("sha256", "older"), "source")
    cited = i["citations"].join(known, "source", "left").select(
        "rule_id", "source",
        F.when(F.col("version") == "current", F.col("sha256")).otherwise(F.col("older"))
        .alias("source_sha256"),
    )
    return gates.source_drift(cited, now)


@query
def stated_numbers(i: Inputs) -> DataFrame:
    return sentences.stated_numbers(i["documents"], "doc_id", "text")


@query
def stated_quote_numbers(i: Inputs) -> DataFrame:
    return sentences.stated_numbers(i["receipts"], "rule_id", "quote")


def _both(i: Inputs, gate: Callable[[DataFrame, str, str], DataFrame], only: str | None = None) -> DataFrame:
    """A gate over both notations of every receipt."""
    # Rule ids of this corpus are unique, so findings go without their pack.
    receipts = i["receipts"].drop("pack") if only is None else i["receipts"].drop("pack").where(only)
    first = gate(receipts, "requirement", "expression").withColumn("notation", F.lit("expression"))
    second = gate(receipts, "feel", "feel").withColumn("notation", F.lit("feel"))
    return first.unionByName(second)


@query
def number_gate(i: Inputs) -> DataFrame:
    return _both(i, gates.number_gate)


@query
def vocabulary_gate(i: Inputs) -> DataFrame:
    return _both(i, gates.vocabulary_gate)


@query
def encoding_gate(i: Inputs) -> DataFrame:
    return _both(i, gates.encoding_gate)


@query
def day_test_gate(i: Inputs) -> DataFrame:
    return _both(i, gates.day_test_gate, "kind = 'derived_field'")


@query
def forbidden_constructs(i: Inputs) -> DataFrame:
    return _both(i, gates.forbidden_constructs)


@query
def expression_uses(i: Inputs) -> DataFrame:
    receipts = i["receipts"]
    first = expressions.uses(receipts, "requirement", "expression", ["rule_id"])
    second = expressions.uses(receipts, "feel", "feel", ["rule_id"])
    return first.withColumn("notation", F.lit("expression")).unionByName(
        second.withColumn("notation", F.lit("feel"))
    )


@query
def allowlist_gate(i: Inputs) -> DataFrame:
    """What the rules of both notations call, and what the vocabulary lets them call."""
    called = expressions.uses(i["receipts"], "requirement", "expression", ["rule_id"], begin=expressions.NAMES)
    first = called.where("kind in ('function', 'method')").select("kind", "name").unionByName(gates.listed_names(i.spark))
    second = expressions.uses(i["receipts"], "feel", "feel", ["rule_id"], begin=expressions.NAMES).where("kind = 'function'")
    return gates.allowlist_gate(first).unionByName(gates.allowlist_gate(second, "feel"))


@query
def row_receipt_mismatch(i: Inputs) -> DataFrame:
    return gates.row_mismatch(i["receipts"], i["model_rows"])


@query
def dmn_row_receipt_mismatch(i: Inputs) -> DataFrame:
    return gates.dmn_row_mismatch(i["receipts"], i["dmn_model_rows"])


@query
def orphan_rows(i: Inputs) -> DataFrame:
    """Over both formats of the model."""
    return gates.orphans(i["receipts"], i["model_rows"], i["dmn_model_rows"])


@query
def graph_integrity(i: Inputs) -> DataFrame:
    return gates.graph_integrity(i["nodes"], i["edges"])


def _hashed(frame: DataFrame) -> DataFrame:
    return frame.select("rule_id", F.sha2("content", 256).alias("content_sha256"))


@query
def pack_diff(i: Inputs) -> DataFrame:
    return gates.pack_diff(_hashed(i["old_rules"]), _hashed(i["new_rules"]))


@query
def pack_status(i: Inputs) -> DataFrame:
    """A pack per customer: findings are its failed orders, questions its open ones."""
    customers = i["customer"].select(F.col("c_custkey").alias("pack"))
    orders = i["orders"].withColumnRenamed("o_custkey", "pack")
    return gates.pack_status(
        customers,
        orders.where("o_orderstatus = 'F' and o_orderkey % 7 = 0"),
        orders.where("o_orderstatus = 'O' and o_orderkey % 5 = 0"),
        orders.where("o_orderstatus = 'P' and o_orderkey % 3 = 0"),
    )


@query
def blocked_rules(i: Inputs) -> DataFrame:
    return blocking.blocked_rules(i["definitions"], i["uses"])


@query
def fixture_skip(i: Inputs) -> DataFrame:
    states = i["customer"].select(
        F.col("c_custkey").cast("string").alias("subsection"), (F.col("c_nationkey") % 3 == 0).alias("open")
    )
    return gates.fixture_skip(i["fixtures"], states).select("fixture_id", "subsection")


@query
def quote_search(i: Inputs) -> DataFrame:
    return quotes.quote_search(i["benchmark"], i["documents"], "item_id", "doc_id")


# --- test cases -------------------------------------------------------------------------------

def _cases(i: Inputs) -> DataFrame:
    """A test case per loan, of four kinds, with expectations that hold for some."""
    k = F.col("loan_id")
    text = F.lit(None).cast("string")
    dates = F.lit(None).cast("array<date>")
    kind = k % 4
    result = F.when(k % 3 == 0, "pass").when(k % 3 == 1, "fail").otherwise("not_applicable")
    expected = F.struct(
        F.when(kind == 0, result).when(kind == 1, F.lit("not_applicable")).otherwise(text).alias("result"),
        F.when(kind == 2, F.col("closing_date").cast("string")).otherwise(text).alias("value"),
        F.when(kind == 3, F.array("closing_date")).otherwise(dates).alias("includes"),
        F.when(kind == 3, F.array("cd.issue_date")).otherwise(dates).alias("excludes"),
    )
    return i.loans().select(
        k.alias("test_id"),
        F.when((kind == 0) & (k % 5 == 0), TIMESHARE_RULE)
        .when((kind == 0) & (k % 7 == 3), "9.9/r9")
        .when(kind == 0, GENERAL_RULE)
        .when(kind == 2, RECEIPT_RULE)
        .alias("rule_id"),
        F.when(kind == 1, TIMESHARE_PARAGRAPH).alias("subsection"),
        F.when(kind == 2, "derived.cd_receipt_date").when(kind == 3, "derived.business_days").alias("field"),
        expected.alias("expected"),
        "cd", "closing_date", "transaction", "calendar",
    )


@query
def test_failures(i: Inputs) -> DataFrame:
    return checks.test_failures(_cases(i), timing_pack())


@query
def rules_under_test(i: Inputs) -> DataFrame:
    cases = _cases(i).select("test_id", "rule_id", "subsection", F.col("expected.result").alias("result"))
    return checks.rules_under_test(cases, rules.rules_frame(i.spark, timing_pack()))


@query
def coverage_gaps(i: Inputs) -> DataFrame:
    return checks.coverage_gaps(i["test_cases"], i["test_rules"])


@query
def target_disagreements(i: Inputs) -> DataFrame:
    """The array form against the calendar form: no row is on one side only."""
    loans, pack = i.loans(), timing_pack()
    return checks.disagreements(rules.evaluate(loans, pack), calendar.evaluate_by_calendar(loans, pack))


@query
def edition_disagreements(i: Inputs) -> DataFrame:
    """Two editions of a rule set that do differ, row by row."""
    return checks.disagreements(i["old_rules"], i["new_rules"])


@query
def test_run(i: Inputs) -> DataFrame:
    catalogue = rules.rules_frame(i.spark, timing_pack()).select("rule_id", F.lit("rule").alias("kind"))
    return checks.test_run(_cases(i), timing_pack(), catalogue)


# --- reports ----------------------------------------------------------------------------------

def _sentence_table(i: Inputs) -> DataFrame:
    return i.stored("doc_sentences").select(
        F.col("doc_id").alias("source"), F.col("n").alias("seq"), "sentence_id", "heading", "text"
    )


def _readback(i: Inputs) -> DataFrame:
    table = _sentence_table(i)
    states = table.select(
        "sentence_id",
        F.when((F.col("source") + F.col("seq")) % 11 == 0, "QUESTION")
        .when(F.col("seq") % 3 == 0, "NOT_A_RULE").otherwise("RULE").alias("state"),
    )
    links = table.where(F.col("seq") % 5 == 0).select(
        "sentence_id", F.lit("reference").alias("kind"), F.col("source").cast("string").alias("target"),
        F.lit("paragraph").alias("cited_as"),
    )
    as_derived = table.select(
        F.col("source").alias("doc_id"), F.col("seq").alias("n"), "sentence_id", "text"
    )
    return report.readback(table, states, _quotes_of(i, as_derived), links)


@query
def readback(i: Inputs) -> DataFrame:
    return report.in_report_order(_readback(i))


@query
def label_phrases(i: Inputs) -> DataFrame:
    return i["labels_of_parts"].select("p_partkey", names.label_phrase(F.col("phrase")).alias("phrase"))


@query
def rule_sentences(i: Inputs) -> DataFrame:
    return report.rule_sentences(i["model_rows"])


@query
def readback_stale(i: Inputs) -> DataFrame:
    """A committed report in which the lines of some sentences were edited."""
    fresh = _sentence_table(i).select("source", "seq", F.col("text").alias("line"))
    edited = (F.col("source") + F.col("seq")) % 50 == 0
    committed = fresh.withColumn("line", F.when(edited, F.replace("line", F.lit("e"), F.lit("E"))).otherwise(F.col("line")))
    return report.readback_stale(committed, fresh)


@query
def loan_explanations(i: Inputs) -> DataFrame:
    """Verdicts with their basis; the receipts are the catalogue of the pack, two rows."""
    basis = i.spark.createDataFrame(
        [
            (GENERAL_RULE, GENERAL_PARAGRAPH, "no later than three business days before consummation"),
            (TIMESHARE_RULE, TIMESHARE_PARAGRAPH, "no later than consummation"),
        ],
        "rule_id string, sentence_id string, quote string",
    )
    texts = basis.select("sentence_id", F.concat(F.lit("The consumer receives the disclosures "), "quote", F.lit(".")).alias("text"))
    return report.explain(rules.evaluate(i.loans(), timing_pack()), basis, texts)


# --- stream -----------------------------------------------------------------------------------

def _loans_of_orders(i: Inputs) -> Callable[[DataFrame], DataFrame]:
    return lambda orders: nest_loans(i.spark.sql(SQL["flat_loans"], orders=orders))


@query
def stream_verdicts(i: Inputs) -> DataFrame:
    out = shared_path(i.spark, "stream")
    # A pattern, as the table is one file here and a folder of files elsewhere.
    path = f"{i.sf_dir}/orders.parque[t]"
    loans = streaming.table_stream(i.spark, path, _loans_of_orders(i))
    streaming.stream_verdicts(loans, timing_pack(), out).awaitTermination()
    return i.spark.read.parquet(f"{out}/verdicts").select("loan_id", "rule_id", "result")
