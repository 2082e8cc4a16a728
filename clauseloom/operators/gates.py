"""Audit gates over a corpus of receipts. Each returns findings: (check, subject, detail), and the pack
where the receipts name theirs, so that very many packs are audited at once.

A receipt ties a rule to the sentence it was compiled from, by a quote. Gates that need only the
receipt are row-wise. Gates that compare two tables join on ids that are unique on one side; the
side that can be hot (many receipts of one sentence or source) is reduced before the join, and
what is left to a shuffle is splittable by the adaptive skew join.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.functions import names
from clauseloom.functions import text as tx
from clauseloom.functions.language import (
    DATE_METHODS,
    DAY_SET_TEXT,
    EXPRESSION_FUNCTIONS,
    FEEL_FUNCTIONS,
    WEEKDAYS,
)
from clauseloom.model import LOAN_VOCABULARY, Vocabulary
from clauseloom.operators import expressions as ex
from clauseloom.operators.rows import value_rows

FINDING = ("check", "subject", "detail")


def own(frame: DataFrame, *names: str) -> list[str]:
    """The names, with `pack` before them where the rows say which pack they are of. Rule ids are unique
    within a pack only, so whatever joins on them joins on these."""
    return ["pack", *names] if "pack" in frame.columns else list(names)


def _finding(frame: DataFrame, check: str, subject: str, detail) -> DataFrame:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return frame.select(
        *own(frame),
        F.lit(check).alias("check"),
        F.col(subject).cast("string").alias("subject"),
        detail.alias("detail"),
    )


# --- receipts against the text ----------------------------------------------------------------

def quote_missing(receipts: DataFrame, sentences: DataFrame) -> DataFrame:
    """Receipts whose quote is not in their sentence, character for character, or whose sentence
    is unknown.

    The sentences keep their place when the receipts are few (the inner join can send the receipts
    to them), and only (rule_id, found) reaches the second join, whose key is unique.
    """
    cited = sentences.select(F.col("sentence_id"), F.col("text").alias("sentence_text"))
    key = own(receipts, "rule_id")
    checked = cited.join(receipts.select(*key, "sentence_id", "quote"), "sentence_id").select(
        *key, F.coalesce(F.contains("sentence_text", "quote"), F.lit(False)).alias("found")
    )
    status = receipts.select(*key, "sentence_id").join(checked, key, "left")
    wrong = status.where(F.col("found").isNull() | ~F.col("found"))
    return _finding(
        wrong,
        "quote",
        "rule_id",
        F.when(F.col("found").isNull(), F.concat(F.lit("unknown sentence "), "sentence_id"))
        .otherwise(F.concat(F.lit("quote not in "), "sentence_id")),
    )


def source_drift(receipts: DataFrame, sources: DataFrame) -> DataFrame:
    """Receipts whose recorded source hash is not the current one.

    A source may be cited by a third of all receipts, so the comparison runs on the distinct
    (source, hash) pairs, which combine before the shuffle. Pairs that drifted are few, and
    receipts meet only those. A receipt of a source that is not there drifted, whatever it recorded:
    two missing hashes are not one hash.
    """
    pairs = receipts.select("source", "source_sha256").distinct()
    current = sources.select("source", F.col("sha256").alias("current_sha256"), F.lit(True).alias("there"))
    drifted = pairs.join(current, "source", "left").where(
        F.col("current_sha256").isNull() | ~F.col("source_sha256").eqNullSafe(F.col("current_sha256"))
    )
    hit = receipts.join(
        drifted.select(
            F.col("source").alias("d_source"),
            F.col("source_sha256").alias("d_sha"),
            F.col("there").isNull().alias("gone"),
        ),
        F.col("source").eqNullSafe(F.col("d_source")) & F.col("source_sha256").eqNullSafe(F.col("d_sha")),
    )
    return _finding(
        hit,
        "source",
        "rule_id",
        F.concat(
            F.when(F.col("gone"), F.lit("no source ")).otherwise(F.lit("hash differs for ")),
            F.coalesce("source", F.lit("null")),
        ),
    )


def changed_sources(recorded: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources a pack was built from that have changed or gone since: one row per source."""
    current = sources.select("source", F.col("sha256").alias("current_sha256"))
    off = recorded.select(*own(recorded, "source", "sha256")).distinct().join(current, "source", "left").where(
        F.col("current_sha256").isNull() | ~F.col("sha256").eqNullSafe(F.col("current_sha256"))
    )
    return _finding(off, "source", "source", "changed since the pack was built")


# --- one rule text ----------------------------------------------------------------------------

def _number_details(notation: str, numbers: str, stated: Column) -> Column:
    """Details of the numbers of an array (name, role) that the quote does not state, null for others. A
    list position counts as the ordinal it takes; the count of a duration counts as a number.

    Each step names what the next one asks of it more than once.
    """
    valued = F.transform(numbers, lambda u: F.struct(
        u["name"].alias("name"), u["role"].alias("role"), u["name"].startswith("-").alias("negative"),
        tx.canonical_number(F.ltrim(u["name"], F.lit("-"))).alias("value"),
    ))

    def element(u: Column) -> Column:
        shifted = F.when((u["role"] == "index") & u["value"].rlike(r"^\d+$"), _next_whole(u["value"]))
        return F.coalesce(shifted, u["value"]) if notation == "expression" else u["value"]

    placed = F.transform(valued, lambda u: u.withField("element", element(u)))

    def detail(u: Column) -> Column:
        name, role, value, negative = u["name"], u["role"], u["value"], u["negative"]
        below = negative if notation == "expression" else (negative | (value == "0"))
        return (
            F.when((role == "index") & below, F.concat(F.lit("index ["), name, F.lit("] is not allowed")))
            .when((role == "plain") & negative, F.concat(F.lit("number "), name, F.lit(" is not stated")))
            .when(F.array_contains(stated, u["element"]), F.lit(None))
            .when(role == "index",
                  F.concat(F.lit("index ["), name, F.lit("] (element "), u["element"], F.lit(") is not stated")))
            .when(role == "duration", F.concat(F.lit("duration of "), value, F.lit(" is not stated")))
            .when(role == "plain", F.concat(F.lit("number "), name, F.lit(" is not stated")))
        )

    return F.transform(placed, detail)


def _next_whole(digits: Column) -> Column:
    """The whole number after the one written in digits, of any length, as text."""
    head = F.regexp_extract(digits, r"^(\d*?)([0-8]?)9*$", 1)
    last = F.regexp_extract(digits, r"^(\d*?)([0-8]?)9*$", 2)
    nines = F.length(digits) - F.length(head) - F.length(last)
    raised = F.when(last == "", F.lit("1")).otherwise(F.translate(last, "012345678", "123456789"))
    return F.concat(head, raised, F.repeat(F.lit("0"), nines))


def number_gate(receipts: DataFrame, text: str, notation: str) -> DataFrame:
    """Numbers of a rule that its quote does not state. Quote and rule are in one row, so the set
    difference is taken within it: only what is wrong becomes a row, and only the quotes of rules
    with numbers are searched for theirs."""
    key = own(receipts, "rule_id")
    cut = ex.cut_texts(receipts, text, notation, [*key, "quote"])
    counted = cut.select(*key, "quote", ex.number_uses(notation).alias("numbers"))
    stated = F.when(F.size("numbers") > 0, tx.stated_numbers(F.col("quote")))
    judged = counted.select(*key, "numbers", stated.alias("stated"))
    details = _number_details(notation, "numbers", F.col("stated"))
    found = judged.select(*key, F.array_compact(details).alias("details")).select(
        *key, F.explode_outer("details").alias("detail")
    )
    return _finding(found.where(F.col("detail").isNotNull()), "number", "rule_id", F.col("detail"))


def vocabulary_gate(
    receipts: DataFrame, text: str, notation: str, vocabulary: Vocabulary = LOAN_VOCABULARY
) -> DataFrame:
    """Names a rule uses that the vocabulary does not list. The vocabulary is closed and written
    by people: a few dozen names, an in-list of the plan."""
    if notation == "expression":
        known = {
            "field": [*vocabulary.fields, *vocabulary.derived],
            "function": list(vocabulary.functions),
            "method": list(vocabulary.methods),
        }
    else:
        derived = [d.replace(".", "_") for d in vocabulary.derived]
        known = {"field": [*vocabulary.fields, *derived], "function": list(FEEL_FUNCTIONS)}
    kind, name = F.col("kind"), F.col("name")
    unknown = F.lit(False)
    for k, names in known.items():
        unknown = unknown | ((kind == k) & ~name.isin(names))
    found = ex.uses(receipts, text, notation, own(receipts, "rule_id"), begin=ex.NAMES).where(unknown)
    return _finding(found, "vocabulary", "rule_id", F.concat(kind, F.lit(" "), name)).distinct()


def _word_stated(word: str) -> Column:
    return F.col("quote").rlike(rf"(?i)\b{re.escape(word)}s?\b")


def encoding_gate(
    receipts: DataFrame, text: str, notation: str, vocabulary: Vocabulary = LOAN_VOCABULARY
) -> DataFrame:
    """Weekday constants whose word the quote does not carry (plural and any case allowed)."""
    role = F.col("role") == "weekday" if notation == "expression" else F.col("kind") == "weekday"
    begin = ex.NUMBERS if notation == "expression" else '"'
    allowed = F.lit(False)
    for number, word in vocabulary.encodings.items():
        name = str(number) if notation == "expression" else word
        allowed = allowed | ((F.col("name") == name) & _word_stated(word))
    # Only a text that names a weekday can compare with one.
    dated = receipts.where(F.contains(F.col(text), F.lit("week")))
    found = ex.uses(dated, text, notation, own(receipts, "rule_id", "quote"), begin=begin).where(role & ~allowed)
    return _finding(found, "encoding", "rule_id", F.concat(F.lit("weekday "), "name")).distinct()


def day_test_gate(receipts: DataFrame, text: str, notation: str) -> DataFrame:
    """Day tests that do not mention the day. The receipts given are those of day sets."""
    day = "#" if notation == "expression" else "item"
    toks = ex.tokens(F.col(text), notation)
    mentioned = F.exists(toks, lambda t: (t == day) | t.startswith(day + "."))
    silent = value_rows(receipts, own(receipts, "rule_id"), "silent", F.when(~mentioned, day))
    return _finding(silent, "day test", "rule_id", f"the test does not use {day}")


def empty_texts(receipts: DataFrame, text: str) -> DataFrame:
    """Rules whose requirement or expression says nothing."""
    return _finding(receipts.where(F.trim(F.col(text)) == ""), "construct", "rule_id", "empty expression")


def forbidden_constructs(receipts: DataFrame, text: str, notation: str) -> DataFrame:
    """Assignments, templates, literals of objects, several statements, odd durations and day
    names, and texts that end in the middle or leave a bracket open."""
    toks = ex.tokens(F.col(text), notation)
    key = own(receipts, "rule_id")
    cut = receipts.select(*key, text, toks.alias("toks"))
    # A single dash stands for "any" in a cell.
    last = F.when(F.trim(F.col(text)) != "-", F.try_element_at("toks", F.lit(-1)))

    def count(*marks: str) -> Column:
        return F.size(F.filter("toks", lambda t: t.isin(*marks)))

    shape = value_rows(
        cut,
        key,
        "detail",
        F.when(
            last.rlike(r"^(?:[-+*/%^<>?:,.=]|==|!=|<=|>=|\?\?|\*\*)$|^(?:and|or|not|in|then|else|return)$"),
            "the text ends in the middle",
        ),
        F.when(count("(", "[", "{") != count(")", "]", "}"), "brackets do not match"),
    )
    odd_day = (F.col("kind") == "weekday") & ~F.col("name").isin(*WEEKDAYS)
    if notation == "expression":
        odd_day = F.lit(False)
    named = ex.uses(receipts, text, notation, key, begin=ex.MARKS[notation]).where(
        (F.col("kind") == "unsupported") | odd_day
    )
    name = F.when(F.col("kind") == "weekday", F.concat(F.lit("day name "), "name")).otherwise(F.col("name"))
    return (
        _finding(shape, "construct", "rule_id", F.col("detail"))
        .unionByName(_finding(named, "construct", "rule_id", name))
        .distinct()
    )


def allowlist_gate(functions: DataFrame, notation: str = "expression") -> DataFrame:
    """Listed functions and methods (kind, name) that the language does not document."""
    if notation == "expression":
        documented = [("function", n) for n in EXPRESSION_FUNCTIONS]
        documented += [("method", n) for n in DATE_METHODS]
    else:
        documented = [("function", n) for n in FEEL_FUNCTIONS]
    dim = functions.sparkSession.createDataFrame(documented, "kind string, name string")
    unknown = functions.select("kind", "name").distinct().join(dim, ["kind", "name"], "left_anti")
    return _finding(unknown, "allow list", "name", F.concat(F.col("kind"), F.lit(" is not documented")))


def listed_names(spark: SparkSession, vocabulary: Vocabulary = LOAN_VOCABULARY) -> DataFrame:
    """(kind, name): the functions and methods a vocabulary lists, which `allowlist_gate` holds against
    the language. Rules may call no others, so an undocumented one among them must not be listed."""
    names = [("function", n) for n in vocabulary.functions] + [("method", n) for n in vocabulary.methods]
    return spark.createDataFrame(names, "kind string, name string")


# --- receipts against the model ---------------------------------------------------------------

def expected_rows(receipts: DataFrame) -> DataFrame:
    """The two decision rows a rule's receipt stands for: (row_id, rule_id, i1, i2, result)."""
    pair = F.array(
        F.struct(F.lit("pass").alias("result"), F.col("requirement").alias("i2")),
        F.struct(
            F.lit("fail").alias("result"),
            F.concat(F.lit("not ("), "requirement", F.lit(")")).alias("i2"),
        ),
    )
    key = own(receipts)
    rules = receipts.where(F.col("kind") == "rule")
    return rules.select(*key, "rule_id", F.col("applies_when").alias("i1"), F.explode(pair).alias("r")).select(
        *key, F.concat("rule_id", F.lit("/"), "r.result").alias("row_id"), "rule_id", "i1", "r.i2", "r.result"
    )


def row_mismatch(receipts: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that a receipt promises and that are missing, differ, or are there more than once."""
    return _mismatch(expected_rows(receipts), rows, "row_id", ["rule_id", "i1", "i2", "result"], "row")


def input_entry(cell: Column) -> Column:
    """A boolean cell as an input entry of the second model format: empty is `-`, and one
    `not(...)` over the whole cell goes in parentheses, because a leading `not(` means "the input
    is not", which also holds when the value is missing.

    The `not(` spans the cell when the depth of brackets, texts in quotes left out, comes back to
    zero once only, at its end.
    """
    cell = F.trim(cell)
    marks = F.regexp_extract_all(F.regexp_replace(cell, ex.STRING, ""), F.lit("[()]"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"))

    def step(state: Column, mark: Column) -> Column:
        depth = state["depth"] + F.when(mark == "(", 1).otherwise(-1)
        return F.struct(
            depth.alias("depth"), (state["closed"] + F.when(depth == 0, 1).otherwise(0)).alias("closed")
        )

    spans = cell.startswith("not(") & cell.endswith(")")
    once = F.aggregate(marks, start, step)["closed"] == 1
    return (
        F.when(cell == "", "-")
        .when(spans & once, F.concat(F.lit("("), cell, F.lit(")")))
        .otherwise(cell)
    )


def expected_dmn_rows(receipts: DataFrame) -> DataFrame:
    """The two rules of the second model format a receipt stands for, from its `feel_when` and
    `feel` cells: (xml_id, applies_when, requirement, rule_id, result, description)."""
    negated = F.concat(F.lit("not("), "feel", F.lit(")"))
    pair = F.array(
        F.struct(F.lit("pass").alias("result"), input_entry(F.col("feel")).alias("requirement")),
        F.struct(F.lit("fail").alias("result"), input_entry(negated).alias("requirement")),
    )
    key = own(receipts)
    rules = receipts.where(F.col("kind") == "rule").select(
        *key, "rule_id", input_entry(F.col("feel_when")).alias("applies_when"), F.explode(pair).alias("r")
    )
    return rules.select(
        *key,
        names.rule_xml_id(F.col("rule_id"), F.col("r.result")).alias("xml_id"),
        "applies_when",
        "r.requirement",
        "rule_id",
        "r.result",
        F.concat("rule_id", F.lit("/"), "r.result").alias("description"),
    )


def dmn_row_mismatch(receipts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for the second model format: rules missing or different from their receipt."""
    cells = ["applies_when", "requirement", "rule_id", "result", "description"]
    return _mismatch(expected_dmn_rows(receipts), rules, "xml_id", cells, "dmn rule")


def _mismatch(want: DataFrame, have: DataFrame, key: str, cells: list[str], check: str) -> DataFrame:
    """Both sides are tagged and grouped once by (pack, key): counts, and the least and the greatest of
    the cells, combine before the shuffle, so neither many rows of one key nor a small side matter."""
    group = own(want, key)
    sides = [
        frame.select(*group, F.struct(*cells).alias("cells"), F.lit(n).alias("given"))
        for frame, n in ((want, 0), (have, 1))
    ]
    met = sides[0].unionByName(sides[1]).groupBy(*group).agg(
        F.count(F.when(F.col("given") == 0, 1)).alias("n_want"), F.count(F.when(F.col("given") == 1, 1)).alias("n_have"),
        F.min("cells").alias("least"), F.max("cells").alias("most"),
    ).where(F.col("n_want") > 0)
    detail = (
        F.when(F.col("n_have") == 0, f"missing {check}")
        .when(F.col("least") != F.col("most"), f"{check} differs")
        .when(F.col("n_have") > F.col("n_want"), f"{check} is there more than once")
    )
    off = value_rows(met, group, "detail", detail)
    return _finding(off, check, key, F.col("detail"))


def model_text(text: Column, notation: str, vocabulary: Vocabulary = LOAN_VOCABULARY) -> Column:
    """A derived receipt's expression as the model writes it: the day test of a day set (column
    `field` names it) stands inside its window, anything else stands as it is."""
    out = text
    for name, window in vocabulary.windows.items():
        filled = DAY_SET_TEXT[notation]
        for key, value in (("from", window["from"]), ("to", window["to"]), ("pad", window["pad_days"])):
            filled = filled.replace("{" + key + "}", str(value))
        before, after = filled.split("{test}")
        out = F.when(F.col("field") == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


def derived_mismatch(receipts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Derived fields whose model expression is not the receipt's. Both sides carry
    (rule_id, expression), the receipt's as `model_text` gives it."""
    key = own(receipts, "rule_id")
    off = receipts.select(*key, F.col("expression").alias("want")).join(
        nodes.select(*key, F.col("expression").alias("have")), key, "left"
    ).where(~F.col("want").eqNullSafe(F.col("have")))
    return _finding(off, "derived field", "rule_id", "the model differs from the receipt")


def orphans(receipts: DataFrame, *models: DataFrame) -> DataFrame:
    """Rules in a model without a receipt, and receipts of rules without a row, for the models of either
    format given, each by itself. One grouping by (pack, rule) over tagged rows, with counts only."""
    group = own(receipts, "rule_id")
    tagged = receipts.select(
        *group, F.lit(True).alias("receipt"), (F.col("kind") == "rule").alias("rule"), F.lit(-1).alias("model"))
    for n, rows in enumerate(models):
        tagged = tagged.unionByName(
            rows.select(*group, F.lit(False).alias("receipt"), F.lit(False).alias("rule"), F.lit(n).alias("model")))
    met = tagged.groupBy(*group).agg(
        F.max("receipt").alias("receipt"), F.max("rule").alias("rule"),
        *[F.max(F.col("model") == n).alias(f"in_{n}") for n in range(len(models))],
    )
    there = [F.col(f"in_{n}") for n in range(len(models))]
    found = value_rows(
        met, group, "detail",
        F.when(~F.col("receipt"), "no receipt"),
        F.when(F.col("rule") & ~reduce(Column.__and__, there), "no row"),  # in one model or in several
    )
    return _finding(found, "orphan", "rule_id", F.col("detail"))


def graph_integrity(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per pack: node ids used twice, edges to nodes that are not there, rules without exactly
    two inputs and two outputs. Subjects read `pack/id`; pack and id are compared apart, so that
    a slash in either makes no two nodes one."""
    subject = F.concat_ws("/", "pack", "node_id")
    odd = F.coalesce((F.col("n_inputs") != 2) | (F.col("n_outputs") != 2), F.lit(False))
    # One grouping tells which nodes are there, which twice, and which are odd.
    there = nodes.groupBy("pack", "node_id").agg(F.count("*").alias("n"), F.max(odd).alias("odd"))
    ends = edges.select(
        "pack", F.concat_ws("/", "pack", "edge_id").alias("edge"),
        F.explode(F.array("source_id", "target_id")).alias("node_id"),
    )
    # Many edges may name one node: named nodes meet the nodes once each, and only the few that
    # are not there go back to the edges.
    named = ends.select("pack", "node_id").distinct().alias("e")
    same = F.col("e.pack").eqNullSafe(F.col("n.pack")) & F.col("e.node_id").eqNullSafe(F.col("n.node_id"))
    lost = named.join(there.alias("n"), same, "left_anti").alias("n")
    dangling = ends.alias("e").join(lost, same).select(
        "edge", F.concat(F.lit("names no node: "), F.concat_ws("/", "e.pack", "e.node_id")).alias("detail"))
    broken = there.select(
        subject.alias("subject"),
        F.explode(F.array(
            F.when(F.col("n") > 1, "id is used twice"),
            F.when(F.col("odd"), "needs two inputs and two outputs"),
        )).alias("detail"),
    ).where(F.col("detail").isNotNull())
    return _finding(broken, "graph", "subject", F.col("detail")).unionByName(
        _finding(dangling, "graph", "edge", F.col("detail"))
    )


# --- packs ------------------------------------------------------------------------------------

def pack_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(rule_id, change, previous): added, changed or retired, by content hash."""
    before = old.select("rule_id", F.col("content_sha256").alias("previous"))
    after = new.select("rule_id", F.col("content_sha256").alias("current"))
    both = before.join(after, "rule_id", "full_outer")
    change = (
        F.when(F.col("previous").isNull(), "added")
        .when(F.col("current").isNull(), "retired")
        .when(F.col("previous") != F.col("current"), "changed")
    )
    return both.select("rule_id", change.alias("change"), "previous").where(
        F.col("change").isNotNull()
    )


def unknown_changes(changes: DataFrame, receipts: DataFrame) -> DataFrame:
    """Added or changed rules that have no receipt."""
    key = own(receipts, "rule_id")
    named = changes.where(F.col("change").isin("added", "changed")).select(*key).distinct()
    lost = named.join(receipts.select(*key), key, "left_anti")
    return _finding(lost, "change", "rule_id", "the change names no receipt")


def pack_status(packs: DataFrame, findings: DataFrame, questions: DataFrame, blocked: DataFrame) -> DataFrame:
    """(pack, n_errors, n_open, n_blocked, status, code) per pack. Inputs carry `pack`.

    One grouping over tagged rows instead of three joins: counts combine before the shuffle, so
    a pack with very many findings is cheap.
    """
    tags = ("n_errors", "n_open", "n_blocked")
    tagged = packs.select("pack", F.lit("").alias("tag"))
    for tag, frame in zip(tags, (findings, questions, blocked)):
        tagged = tagged.unionByName(frame.select("pack", F.lit(tag).alias("tag")))
    counts = tagged.groupBy("pack").agg(
        *[F.count(F.when(F.col("tag") == t, 1)).alias(t) for t in tags]
    )
    errors, waiting = F.col("n_errors") > 0, (F.col("n_open") > 0) | (F.col("n_blocked") > 0)
    return counts.withColumn(
        "status", F.when(errors, "fail").when(waiting, "not final").otherwise("pass")
    ).withColumn("code", F.when(errors, 1).when(waiting, 2).otherwise(0))


def fixture_skip(fixtures: DataFrame, sentences: DataFrame) -> DataFrame:
    """Fixtures of a subsection that has an open or blocked sentence."""
    waiting = sentences.where(F.col("open")).select("subsection").distinct()
    return fixtures.join(waiting, "subsection", "left_semi")


def open_questions(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions nobody has answered."""
    return questions.join(answers.select("question_id").distinct(), "question_id", "left_anti")
