"""Rule text as data: which fields, functions, methods and numbers each rule uses.

Rules are decided by Catalyst; this is the audit of a corpus of rule texts. Each text is cut into
tokens by one pattern, and a token's neighbours say what it is. What reaches beyond neighbours, a
comparison with a call of any length, is told by one fold over the tokens with a stack of open
brackets. All of it is row-wise: one pass, no shuffle, whatever the number of rules; tokens that no
caller asks for never become rows. It covers the documented subset, not a number in brackets of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseloom.functions.language import (
    DURATION,
    EXPRESSION_KEYWORDS,
    FEEL_FUNCTIONS,
    FEEL_KEYWORDS,
)
from clauseloom.operators.rows import value_rows

STRING = r'"(?:[^"\\]|\\.)*"'
NUMBER = r"\d+(?:\.\d+)?(?:e[+-]?\d+)?"
NAME = r"\.?[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*"
OPERATOR = r"\.\.|\?\?|\*\*|==|!=|<=|>=|[-+*/%^<>?:,.()\[\]{}#$=;]"
_SPACED = sorted((f for f in FEEL_FUNCTIONS if " " in f), key=len, reverse=True)
SPACED_NAME = "(?:" + "|".join(f.replace(" ", r"\s+") for f in _SPACED) + r")(?=\s*\()"
TOKEN = {
    "expression": rf"{STRING}|'(?:[^'\\]|\\.)*'|`[^`]*`|{NUMBER}|{NAME}|{OPERATOR}",
    "feel": rf"{STRING}|(?<!\w){SPACED_NAME}|{NUMBER}|{NAME}|{OPERATOR}",
}
KEYWORDS = {"expression": EXPRESSION_KEYWORDS, "feel": FEEL_KEYWORDS}
EQUALS = {"expression": ("==", "!="), "feel": ("=", "!=")}


def tokens(text: Column, notation: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(TOKEN[notation]), F.lit(0))
    if notation == "feel":
        return F.transform(
            found,
            lambda t: F.when(t.rlike("^[a-z]"), F.regexp_replace(t, r"\s+", " ")).otherwise(t),
        )
    return found


# What can be of interest in a token, by how it begins.
NUMBERS, NAMES = "0-9", r"\.A-Za-z_"
MARKS = {"expression": "#={$;`", "feel": '"{'}
ARITHMETIC = ("+", "-", "*", "/", "%", "^", "**")
_STACK = "array<struct<start:int,pos:int,name:string>>"
_SPANS = "array<struct<start:int,last:int>>"


def _weekday_call(name: Column, notation: str) -> Column:
    return name.endswith(".weekday") if notation == "expression" else name == "day of week"


def _weekday_spans(toks: Column, notation: str) -> Column:
    """First and last token of each value that is a weekday: a call of it with the whole chain of
    calls, members and elements before it, and brackets around that.

    One fold. The stack holds, per open bracket, where the value it belongs to starts and which call it
    opens; `start` is where the value that ends at the last token starts.
    """
    at = F.lit(0)
    first = F.struct(
        at.alias("at"), F.lit(None).cast("int").alias("start"), F.lit("").alias("prev"),
        F.expr(f"cast(array() as {_STACK})").alias("stack"), F.expr(f"cast(array() as {_SPANS})").alias("spans"),
    )

    def is_name(t: Column) -> Column:
        return t.rlike(r"^\.?[A-Za-z_]") & ~t.isin(*KEYWORDS[notation])

    def step(s: Column, t: Column) -> Column:
        at, stack, spans, prev = s["at"], s["stack"], s["spans"], s["prev"]
        opens, closes, top = t.isin("(", "[", "{"), t.isin(")", "]", "}"), F.get(stack, 0)
        called = (t == "(") & is_name(prev)
        begin = F.when(called | ((t == "[") & _ends_value(prev)), F.coalesce(s["start"], at)).otherwise(at)
        pushed = F.concat(
            F.array(F.struct(begin.alias("start"), at.alias("pos"), F.when(called, prev).otherwise("").alias("name"))),
            stack,
        )
        group = (t == ")") & (top["name"] == "")
        around = group & F.exists(spans, lambda x: (x["start"] == top["pos"] + 1) & (x["last"] == at - 1))
        found = closes & (_weekday_call(top["name"], notation) | around)
        start = F.when(opens, F.lit(None)).when(closes, top["start"]).when(t.startswith("."), s["start"]).otherwise(at)
        return F.struct(
            (at + 1).alias("at"), start.cast("int").alias("start"), t.alias("prev"),
            F.when(opens, pushed).when(closes, F.slice(stack, 2, F.greatest(F.size(stack), F.lit(1))))
            .otherwise(stack).cast(_STACK).alias("stack"),
            F.when(found, F.concat(spans, F.array(F.struct(top["start"].alias("start"), at.alias("last")))))
            .otherwise(spans).cast(_SPANS).alias("spans"),
        )

    return F.aggregate(toks, first, step, lambda s: s["spans"])


def _weekday_places(toks: Column, notation: str) -> Column:
    """The tokens that stand across an (in)equality from a weekday. A weekday that is part of a sum is
    not itself compared."""

    def sides(x: Column) -> Column:
        before, after = F.get(toks, x["start"] - 1), F.get(toks, x["last"] + 1)
        free = [~F.coalesce(mark.isin(*ARITHMETIC), F.lit(False)) for mark in (before, after)]
        return F.array(
            F.when(before.isin(*EQUALS[notation]) & free[1], x["start"] - 2),
            F.when(after.isin(*EQUALS[notation]) & free[0], x["last"] + 2),
        )

    return F.array_compact(F.flatten(F.transform(_weekday_spans(toks, notation), sides)))


def cut_texts(rules: DataFrame, text: str, notation: str, keep: list[str]) -> DataFrame:
    """(keep, toks, places): the tokens of each text, and which of them are compared with a weekday. Only
    texts that name a weekday are folded."""
    cut = rules.select(*keep, F.contains(F.col(text), F.lit("week")).alias("dated"),
                       tokens(F.col(text), notation).alias("toks"))
    none = F.expr("cast(array() as array<int>)")
    places = F.when(F.col("dated"), _weekday_places(F.col("toks"), notation)).otherwise(none)
    return cut.select(*keep, "toks", places.alias("places"))


def _of_interest(begin: str) -> Column:
    """(pos, t, neighbours) of the tokens that begin with one of the given characters."""
    placed = F.transform("toks", lambda t, i: F.struct(i.alias("pos"), t.alias("t")))
    asked = F.filter(placed, lambda s: s["t"].rlike(f"^[{begin}]"))

    def beside(s: Column, d: int) -> Column:
        return F.get(F.col("toks"), s["pos"] + d)

    return F.transform(
        asked,
        lambda s: F.struct(
            s["pos"].alias("pos"), s["t"].alias("t"),
            *[beside(s, -d).alias(f"b{d}") for d in (1, 2, 3)], *[beside(s, d).alias(f"a{d}") for d in (1, 2)],
        ),
    )


def number_uses(notation: str) -> Column:
    """The numbers of a text cut by `cut_texts`: an array of (kind, name, role), for row-wise gates."""
    begin = NUMBERS if notation == "expression" else NUMBERS + '"'

    def use(s: Column) -> Column:
        found = F.when(s["t"].rlike("^[0-9]"), _numbers(notation, s))
        return found if notation == "expression" else found.otherwise(_duration(s))

    return F.filter(F.transform(_of_interest(begin), use), lambda u: u["kind"] == "number")


def uses(rules: DataFrame, text: str, notation: str, keep: list[str], begin: str | None = None) -> DataFrame:
    """(keep, pos, kind, name, role): fields, functions, methods, numbers, weekdays, day
    references, and what a rule must not contain. `begin` limits it to tokens that begin so.

    What several branches ask of a token is computed in a step of its own: generated code beyond
    the size the JVM compiles would run interpreted.
    """
    binder = "as" if notation == "expression" else "for"
    after = F.transform("toks", lambda t, i: F.when(t == binder, F.get(F.col("toks"), i + 1)))
    bound = F.when(F.array_contains("toks", binder), F.array_compact(after)).otherwise(
        F.expr("cast(array() as array<string>)"))
    cut = cut_texts(rules, text, notation, keep)
    cut = cut.select(*keep, "places", bound.alias("bound"),
                     _of_interest(begin or NUMBERS + NAMES + MARKS[notation]).alias("found"))
    rows = cut.select(*keep, "places", "bound", F.explode_outer("found").alias("x")).where(
        F.col("x").isNotNull()).select(*keep, "places", "bound", "x.*")
    t = F.col("t")
    rows = rows.withColumns(
        {
            "is_name": t.rlike("^[A-Za-z_]"),
            "is_number": t.rlike("^[0-9]"),
            "called": F.coalesce(F.col("a1") == "(", F.lit(False)),
            "own": F.array_contains("bound", F.substring_index(t, ".", 1)),
            "keyword": t.isin(*KEYWORDS[notation]),
        }
    )
    found = _expression_uses() if notation == "expression" else [_feel_use()]
    return value_rows(rows, [*keep, "pos"], "u", *found).select(*keep, "pos", "u.*")


def _use(kind: str, name: Column, role: str = "") -> Column:
    return F.struct(F.lit(kind).alias("kind"), name.alias("name"), F.lit(role).alias("role"))


def _ends_value(tok: Column) -> Column:
    """Whether a token can end a value, so that a bracket after it takes an element of it."""
    return tok.rlike(r"^(?:\)|\]|\"|'|\.?[A-Za-z_])") & ~tok.isin(
        *EXPRESSION_KEYWORDS, "then", "else", "return"
    )


def _fields(s: Column | None, *names: str) -> list[Column]:
    """Columns of a row of tokens, or fields of a token in an array."""
    return [F.col(n) if s is None else s[n] for n in names]


def _numbers(notation: str, s: Column | None = None) -> Column:
    pos, t, b1, b2, b3, a1 = _fields(s, "pos", "t", "b1", "b2", "b3", "a1")
    minus = b1 == "-"
    indexed = (a1 == "]") & (
        ((b1 == "[") & _ends_value(b2)) | (minus & (b2 == "[") & _ends_value(b3))
    )
    signed = F.coalesce(minus & (b2.isNull() | ~(_ends_value(b2) | b2.rlike(r"^\d"))), F.lit(False))
    value = F.when(signed, F.concat(F.lit("-"), t)).otherwise(t)
    number = F.when(F.coalesce(indexed, F.lit(False)), _use("number", value, "index"))
    if notation == "expression":
        places = F.col("places")
        across = F.array_contains(places, pos) | (signed & F.array_contains(places, pos - 1))
        part = F.coalesce(a1.isin(*ARITHMETIC), F.lit(False)) | (
            ~signed & F.coalesce(b1.isin(*ARITHMETIC), F.lit(False)))
        number = number.when(across & ~part, _use("number", value, "weekday"))
    return number.otherwise(_use("number", value, "plain"))


def _duration(s: Column | None = None) -> Column:
    """The count of a duration literal, or what is wrong with it; null for other tokens."""
    t, b1, b2, a1 = _fields(s, "t", "b1", "b2", "a1")
    text = F.substring(t, F.lit(2), F.length(t) - 2)
    literal = t.startswith('"') & (b1 == "(") & (b2 == "duration") & (a1 == ")")
    return F.when(literal & text.rlike(DURATION),
                  _use("number", F.regexp_extract(text, "[0-9]+", 0), "duration")).when(
        literal, _use("unsupported", F.concat(F.lit("duration literal "), text)))


def _expression_uses() -> list[Column]:
    t = F.col("t")
    is_name, called, dotted = F.col("is_name"), F.col("called"), t.contains(".")
    path = F.when(called & dotted, F.regexp_replace(t, r"\.\w+$", "")).otherwise(t)
    # What a rule must not contain, by the mark that gives it away.
    forbidden = {
        "=": "assignment",
        "{": "object literal",
        "$": "$ (value of the tested column)",
        ";": "several statements",
    }
    marks = F.create_map(*[F.lit(x) for pair in forbidden.items() for x in pair])
    return [
        F.when(F.col("is_number"), _numbers("expression"))
        .when(is_name & ~F.col("keyword") & called & ~dotted, _use("function", t))
        .when(is_name & ~F.col("keyword") & ~F.col("own"), _use("field", path))
        .when(t == "#", _use("day", t))
        .when(t.startswith(".") & called, _use("method", F.substring_index(t, ".", -1)))
        .when(t.isin(*forbidden), _use("unsupported", marks[t]))
        .when(t.startswith("`"), _use("unsupported", F.lit("template string"))),
        F.when(is_name & called & dotted, _use("method", F.substring_index(t, ".", -1))),
    ]


def _feel_use() -> Column:
    t, b1, b2, a1 = (F.col(c) for c in ("t", "b1", "b2", "a1"))
    is_name = F.col("is_name")
    is_text = t.startswith('"')
    literal = is_text & (b1 == "(") & (b2 == "duration") & (a1 == ")")
    return (
        F.when(literal, _duration())
        .when(is_text & F.array_contains("places", F.col("pos")),
              _use("weekday", F.substring(t, F.lit(2), F.length(t) - 2)))
        .when(F.col("is_number"), _numbers("feel"))
        .when(t == "{", _use("unsupported", F.lit("context literal")))
        .when(is_name & t.rlike(r"^item\b"), _use("day", F.lit("item")))
        .when(is_name & F.col("called") & (~F.col("keyword")), _use("function", t))
        .when(is_name & ~F.col("keyword") & ~F.col("own"), _use("field", t))
    )
