"""Keys and identifiers made from paragraph labels, rule ids and field paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(text: Column) -> Column:
    """ASCII letters and digits, everything between them as one underscore, none at the ends."""
    return F.trim(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), F.lit("_"))


def subsection_key(label: Column) -> Column:
    return F.concat(F.lit("s"), slug(label))


def rule_xml_id(rule_id: Column, verdict: Column) -> Column:
    return F.concat(F.lit("rule_"), slug(rule_id), F.lit("_"), verdict)


def input_xml_id(field: Column) -> Column:
    return F.concat(F.lit("input_"), slug(field))


def feel_name(path: Column) -> Column:
    """A dotted path as a name without dots."""
    return F.replace(path, F.lit("."), F.lit("_"))


def label_phrase(label: Column) -> Column:
    """A label as a noun phrase: `the ` in front unless it starts with `the ` or `how `."""
    return F.when(label.rlike("^(the|how) "), label).otherwise(F.concat(F.lit("the "), label))


def labelled(text: Column, labels: dict[str, str]) -> Column:
    """Rule text with each field path replaced by its label phrase. The text is cut into paths and
    what stands between them, and each path is looked up."""
    phrases = {
        path: label if label.startswith(("the ", "how ")) else f"the {label}"
        for path, label in labels.items()
    }
    lookup = F.map_from_arrays(
        F.array(*[F.lit(p) for p in phrases]), F.array(*[F.lit(p) for p in phrases.values()])
    )
    pieces = F.regexp_extract_all(text, F.lit(r"[\w.]+|[^\w.]+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(lookup[p], p)), "")


def rule_sentence(applies_when: Column, requirement: Column, result: Column) -> Column:
    """One decision row as a sentence."""
    lead = F.when(F.trim(applies_when).isin("", "-"), "For every loan file").otherwise(
        F.concat(F.lit("When "), applies_when)
    )
    return F.concat(lead, F.lit(", and "), requirement, F.lit(", the result is **"), result, F.lit("**."))
