"""The audit of packs: every gate over their relations, as one table of findings.

`tables` are the relations of `sources.packs.read_pack`, of one pack or of very many: ids are unique
within a pack, and every gate keeps packs apart. `sentences` has (sentence_id, text), `sources` has
(source, sha256); packs share them. Findings carry (pack, check, subject, detail).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.functions import names
from clauseloom.model import LOAN_VOCABULARY, Vocabulary
from clauseloom.operators import gates


def audit(
    tables: dict[str, DataFrame],
    sentences: DataFrame,
    sources: DataFrame,
    vocabulary: Vocabulary = LOAN_VOCABULARY,
) -> DataFrame:
    """All findings of the text, the rule texts and the models. A pack without one is sound."""
    receipts = tables["receipt"].withColumns(
        {"feel_when": F.coalesce("dmn.applies_when", F.lit("")), "feel": F.col("dmn.requirement")}
    )
    rules = receipts.where(F.col("kind") == "rule")
    derived = receipts.where(F.col("kind") == "derived_field").withColumn(
        "feel", F.col("dmn.expression")
    )
    day_sets = derived.where(
        F.col("field").isin([d for d, kind in vocabulary.derived.items() if kind == "day_set"])
    )
    found = [
        gates.quote_missing(receipts, sentences),
        gates.source_drift(receipts, sources),
        gates.changed_sources(tables["source"], sources),
        gates.row_mismatch(receipts, tables["row"]),
        gates.dmn_row_mismatch(receipts, tables["dmn_rule"]),
        gates.orphans(receipts, tables["row"], tables["dmn_rule"]),
        gates.unknown_changes(tables["change"], receipts),
        _unknown_fields(derived, vocabulary),
        _other_decisions(receipts, tables["decision"]),
        _derived_in_first_model(derived, tables["derived_node"], vocabulary),
        _derived_in_second_model(derived, tables["decision"], vocabulary),
        gates.empty_texts(rules, "requirement"),
        gates.empty_texts(rules, "feel"),
        gates.empty_texts(derived, "expression"),
        gates.empty_texts(derived, "feel"),
    ]
    # All texts of a notation are one corpus, so each gate is planned once per notation.
    first = _texts(
        (rules, "applies_when"), (rules, "requirement"), (derived, "expression")
    )
    second = _texts((rules, "feel_when"), (rules, "feel"), (derived, "feel"))
    for written, notation in ((first, "expression"), (second, "feel")):
        found += [
            gates.number_gate(written, "text", notation),
            gates.vocabulary_gate(written, "text", notation, vocabulary),
            gates.encoding_gate(written, "text", notation, vocabulary),
            gates.forbidden_constructs(written, "text", notation),
        ]
    found += [
        gates.day_test_gate(day_sets, "expression", "expression"),
        gates.day_test_gate(day_sets, "feel", "feel"),
    ]
    # The vocabulary is that of all packs, so what it lists wrongly is a finding of none.
    listed = gates.allowlist_gate(gates.listed_names(receipts.sparkSession, vocabulary))
    found.append(listed.select(*[F.lit(None).cast("string").alias(c) for c in gates.own(receipts)], "*"))
    return reduce(DataFrame.unionByName, found).distinct()


def _derived_in_first_model(derived: DataFrame, nodes: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    want = derived.select(
        *gates.own(derived, "rule_id"),
        gates.model_text(F.col("expression"), "expression", vocabulary).alias("expression"),
    )
    places = derived.select(*gates.own(derived, "rule_id"), F.col("node").alias("node_id"), "field")
    key = gates.own(derived, "node_id", "field")
    return gates.derived_mismatch(want, nodes.select(*key, "expression").join(places, key))


def _derived_in_second_model(derived: DataFrame, decisions: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    want = derived.select(
        *gates.own(derived, "rule_id"), gates.model_text(F.col("feel"), "feel", vocabulary).alias("expression")
    )
    places = derived.select(*gates.own(derived, "rule_id"), F.col("dmn.decision").alias("decision"))
    key = gates.own(derived, "decision")
    literal = decisions.where(F.col("kind") == "literal").select(*key, F.col("text").alias("expression"))
    return gates.derived_mismatch(want, literal.join(places, key))


def _texts(*parts: tuple[DataFrame, str]) -> DataFrame:
    """(pack, rule_id, quote, text) of the given text columns."""
    frames = [
        frame.select(*gates.own(frame, "rule_id"), "quote", F.col(text).alias("text")).where(F.col("text").isNotNull())
        for frame, text in parts
    ]
    return reduce(DataFrame.unionByName, frames)


def _unknown_fields(derived: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Derived receipts whose field the vocabulary does not derive."""
    lost = derived.where(~F.col("field").isin(list(vocabulary.derived)))
    return lost.select(
        *gates.own(derived),
        F.lit("derived field").alias("check"),
        F.col("rule_id").alias("subject"),
        F.concat("field", F.lit(" is not a derived field of the vocabulary")).alias("detail"),
    )


def _other_decisions(receipts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Receipts without a decision in the second model, and derived ones that name another than
    that of their field."""
    named = receipts.select(*gates.own(receipts, "rule_id"), "kind", "field", F.col("dmn.decision").alias("decision"))
    key = gates.own(receipts, "decision")
    known = decisions.select(*key, F.lit(True).alias("known")).distinct()
    joined = named.join(known, key, "left")
    misnamed = (F.col("kind") == "derived_field") & (F.col("decision") != names.feel_name(F.col("field")))
    detail = F.when(F.col("decision").isNull(), "no receipt in the second model").when(
        F.col("known").isNull(), "its decision is not in the second model"
    ).when(misnamed, "its decision is not that of its field")
    return joined.where(detail.isNotNull()).select(
        *gates.own(receipts), F.lit("decision").alias("check"), F.col("rule_id").alias("subject"), detail.alias("detail")
    )
