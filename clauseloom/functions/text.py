"""Text: lines, paragraphs, sentences, and the numbers a text states. One pass per row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, abbreviations and number words of the text format.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
PARAGRAPH = rf"^\[([^\]]+)\]{SPACE}+(.+)$"
HEADING = rf"^_([^_]+?\.)_{SPACE}+"
ITALIC = r"_([^_]+)_"
SENTENCE_END = "[.;]"
SENTENCE_START = rf"{SPACE}+[\"'“‘(]?[A-Z]"
ABBREVIATIONS = (
    "U.S.C.", "U.S.", "Jr.", "Sr.", "e.g.", "i.e.", "No.", "Nos.", "et seq.", "St.", "Inc.", "Co.",
    "vs.", "cf.",
)
DIGITS = r"\d+(?:,\d{3})*(?:\.\d+)?"
HYPHENATED = "[a-z]+-[a-z]+"
UNITS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7,
    "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14,
    "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
}
TENS = {
    "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70,
    "eighty": 80, "ninety": 90,
}
ORDINALS = {
    "first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7,
    "eighth": 8, "ninth": 9, "tenth": 10, "eleventh": 11, "twelfth": 12, "fifteenth": 15,
    "twentieth": 20, "thirtieth": 30,
}
SCALES = {"hundred": 100, "thousand": 1000, "million": 1_000_000}

WORD_VALUES = {**UNITS, **TENS, **ORDINALS}
BELOW_TEN = {w: v for w, v in WORD_VALUES.items() if 0 < v < 10}

# A sentence ends after `.` or `;` before a space and a capital (or an opening quote or bracket),
# unless the text so far ends in an abbreviation.
_BOUNDARY = (
    f"(?<={SENTENCE_END})"
    f"(?<!{'|'.join(a.replace('.', '[.]') for a in ABBREVIATIONS)})"
    f"(?={SENTENCE_START})"
)
_NUMBER_WORD = (
    f"(?<![a-z])(?:{'|'.join(WORD_VALUES)})(?![a-z])"
    f"(?:[^a-z]+(?:{'|'.join(SCALES)})(?![a-z]))?"
)
# Not in normal form only if some character lies at or beyond U+0300; everything below composes
# to itself.
MAY_COMPOSE = r"[^\x00-\x{02ff}]"


def strip(text: Column) -> Column:
    """Without white space at both ends, by the Unicode list of it."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def is_blank(text: Column) -> Column:
    return text.rlike(rf"^{SPACE}*\z")


def heading(paragraph: Column) -> Column:
    """The italic heading in front of a paragraph, null when there is none."""
    found = F.regexp_extract(paragraph, HEADING, 1)
    return F.when(found != "", found)


def body(paragraph: Column) -> Column:
    """The paragraph without its heading and without italic marks."""
    return F.regexp_replace(F.regexp_replace(paragraph, HEADING, ""), ITALIC, "$1")


def sentences(paragraph: Column) -> Column:
    """The sentences of a paragraph body, in order, as slices of it."""
    parts = F.split(body(paragraph), _BOUNDARY)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def canonical_number(digits: Column) -> Column:
    """A digit run as the shortest text of its value. Texts compare exactly at any length."""
    plain = F.regexp_replace(F.replace(digits, F.lit(","), F.lit("")), r"^0+(?=\d)", "")
    return F.when(
        plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")
    ).otherwise(plain)


def stated_numbers(text: Column) -> Column:
    """Every number a text states, as canonical texts, each once: digit runs, number words,
    compounds such as twenty-one, and a word times the scale word right after it."""
    low = F.lower(text)
    digits = F.transform(F.regexp_extract_all(text, F.lit(DIGITS), F.lit(0)), canonical_number)
    tens, small = _values(TENS), _values(BELOW_TEN)
    compounds = F.transform(
        F.regexp_extract_all(low, F.lit(HYPHENATED), F.lit(0)),
        lambda w: tens[F.substring_index(w, "-", 1)] + small[F.substring_index(w, "-", -1)],
    )
    found = F.regexp_extract_all(low, F.lit(_NUMBER_WORD), F.lit(0))
    value, scale = _values(WORD_VALUES), _values(SCALES)
    words = F.flatten(
        F.transform(
            found,
            lambda w: F.array(
                value[F.regexp_extract(w, "^[a-z]+", 0)],
                value[F.regexp_extract(w, "^[a-z]+", 0)]
                * scale[F.regexp_extract(w, "[^a-z]([a-z]+)$", 1)],
            ),
        )
    )
    spelled = F.transform(
        F.array_compact(F.concat(compounds, words)), lambda v: v.cast("string")
    )
    return F.array_distinct(F.concat(digits, spelled))


def _values(words: dict[str, int]) -> Column:
    return F.map_from_arrays(
        F.array(*[F.lit(w) for w in words]), F.array(*[F.lit(v) for v in words.values()])
    )
