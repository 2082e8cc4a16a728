"""Question and answer files: YAML of a fixed shape, read by numbered lines in DataFrame functions.

A file is sections (`questions:`) of items (`- id: ..`), and an item may hold one list of its own
(`readings:`). Lines are told apart by their column: a key starts where the keys of its items or of their
lists start, any other line continues the value before it. Running counts over the lines of a file number
its sections, items, inner items and values; values are then put together by grouping. A file is the
largest unit that one task holds.

Values may be plain, in quotes, folded (`>`) or kept (`|`), over any number of lines; items may be written
as `{key: value, ..}`. Whatever does not fit makes the file unreadable, which is a row like any other:
no file ends the job, and none is taken in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUESTIONS = (
    "pack string, part string, id string, sentence_id string, text string, reading_id string,"
    " answered_by string"
)
# Section -> (part, key of the id, key of the sentence, key of the text).
PARTS = {
    "questions": ("question", "id", "sentence_id", "issue"),
    "answers": ("answer", "question_id", "sentence_id", "reading"),
    "blocked": ("blocked", "id", "sentence_id", "reason"),
    "skipped_fixtures": ("skipped_fixture", "fixture", "subsection", "reason"),
}
_KEY = r"^[A-Za-z_]\w*:(?: |$)"
_PAIR = r"""([A-Za-z_]\w*): *('(?:[^']|'')*'|"(?:[^"\\]|\\.)*"|[^,{}]*)"""


def _lines(bodies: DataFrame) -> DataFrame:
    """(file, pack, no, column, dash, text, keyed): the lines that say something. `column` is where the
    text starts, after the dash of an item if there is one."""
    files = bodies.select(F.monotonically_increasing_id().alias("file"), "pack", F.coalesce("body", F.lit("")).alias("body"))
    lines = files.select("file", "pack", F.posexplode_outer(F.split("body", "\r?\n")).alias("no", "line"))
    indent = F.length(F.regexp_extract("line", "^ *", 0))
    rest = F.rtrim(F.expr("substr(line, indent + 1)"))
    lines = lines.withColumn("indent", indent).withColumn("rest", rest).where("rest <> '' and rest not like '#%'")
    lines = lines.where("not (indent = 0 and rest in ('---', '...'))")
    inner = F.regexp_replace("rest", "^- *", "")
    item = F.col("rest").rlike("^-(?: |$)") & (inner.rlike(_KEY) | inner.startswith("{") | (inner == ""))
    return lines.select(
        "file", "pack", "no", "indent", item.alias("dash"), F.when(item, inner).otherwise(F.col("rest")).alias("text"),
        F.when(item, F.col("indent") + F.length("rest") - F.length(inner)).otherwise(F.col("indent")).alias("column"),
    ).withColumn("keyed", F.col("text").rlike(_KEY))


def _numbered(lines: DataFrame) -> DataFrame:
    """The lines with their section, the numbers of their item, inner item and value, and what is wrong."""
    order = Window.partitionBy("file").orderBy("no")
    top = F.col("keyed") & (F.col("indent") == 0) & ~F.col("dash")
    lines = lines.withColumn("top", top).withColumn("section_no", F.sum(top.cast("int")).over(order))
    section = Window.partitionBy("file", "section_no")
    lines = lines.withColumn("outer", F.min(F.when(F.col("dash"), F.col("indent"))).over(section))
    first, deeper = F.col("dash") & (F.col("indent") == F.col("outer")), F.col("dash") & (F.col("indent") > F.col("outer"))
    lines = lines.withColumns({
        "first": first, "deeper": deeper,
        "own_column": F.min(F.when(first, F.col("column"))).over(section),
        "inner_column": F.min(F.when(deeper, F.col("column"))).over(section),
    })
    key = F.col("keyed") & ~F.col("top") & (F.col("dash") | F.col("column").isin(F.col("own_column"), F.col("inner_column")))
    flow = F.col("dash") & F.col("text").startswith("{")
    lines = lines.withColumns({"key": F.coalesce(key, F.lit(False)), "flow": flow})
    starts = F.col("top") | F.col("key") | F.col("flow") | F.col("dash")
    count = Window.partitionBy("file").orderBy("no")
    lines = lines.withColumns({
        "item": F.sum(F.col("first").cast("int")).over(count),
        "value_no": F.sum(starts.cast("int")).over(count),
        "starts": starts,
    })
    within = Window.partitionBy("file", "section_no", "item").orderBy("no")
    lines = lines.withColumn("inner_no", F.sum(F.coalesce(F.col("deeper"), F.lit(False)).cast("int")).over(within))
    # Keys of the item that follow its inner list belong to the item again.
    back = F.col("key") & ~F.col("dash") & (F.col("column") == F.col("own_column"))
    return lines.withColumn("inner_no", F.when(F.coalesce(back, F.lit(False)), 0).otherwise(F.col("inner_no")))


def _value(raw: Column, more: Column) -> Column:
    """The value of a key from the text behind it and the lines that continue it; `?` in front of what is
    not closed."""
    folded = F.trim(F.concat_ws(" ", raw, F.array_join(more, " ")))
    kept = F.when(raw.startswith("|"), F.array_join(more, "\n")).when(raw.startswith(">"), F.array_join(more, " "))
    single, double = folded.startswith("'"), folded.startswith('"')
    plain = F.regexp_replace(folded, r" #.*$", "")
    return (
        F.when(raw.rlike("^[|>][+-]?$"), kept)
        .when(single & folded.rlike("^'(?:[^']|'')*'$"),
              F.replace(F.expr("substr(folded, 2, length(folded) - 2)"), F.lit("''"), F.lit("'")))
        .when(double & folded.rlike(r'^"(?:[^"\\]|\\.)*"$'),
              F.regexp_replace(F.expr("substr(folded, 2, length(folded) - 2)"), r"\\(.)", "$1"))
        .when(single | double | folded.rlike(r"^[\[{](?![\]}]$)|^[&*!%@`]"), F.lit(None))
        .when(plain.isin("", "null", "~", "[]", "{}"), F.lit(None))
        .otherwise(plain)
    )


def _pairs(lines: DataFrame) -> DataFrame:
    """(file, pack, section_no, item, inner_no, key, value, bad, top): one row per value."""
    text = F.when(F.col("starts"), F.col("text"))
    put = lines.groupBy("file", "pack", "section_no", "value_no").agg(
        F.max("item").alias("item"), F.max(F.when(F.col("starts"), F.col("inner_no"))).alias("inner_no"),
        F.max(text).alias("head"), F.max("top").alias("top"), F.max("flow").alias("flow"),
        F.max("own_column").alias("own_column"),
        F.array_sort(F.collect_list(F.when(~F.col("starts"), F.struct("no", "text", "column")))).alias("more"),
    )
    put = put.withColumn("raw", F.trim(F.regexp_replace("head", r"^\w+: *", ""))).withColumn(
        "folded", F.trim(F.concat_ws(" ", "raw", F.array_join("more.text", " "))))
    strays = F.exists("more", lambda m: m["column"] <= F.coalesce(F.col("own_column"), F.lit(-1)))
    lost = F.col("head").isNull() | (F.col("top") & ((F.size("more") > 0) | ~F.col("raw").isin("", "[]", "null", "~")))
    open_ = F.col("folded").rlike(r"""^(?:'(?!(?:[^']|'')*'$)|"(?!(?:[^"\\]|\\.)*"$)|[\[{](?![\]}]$)|[&*!%@`])""")
    whole = F.trim(F.concat_ws(" ", "head", F.array_join("more.text", " ")))
    broken = F.col("flow") & ~whole.rlike(r"^\{.*\}$")
    bad = F.coalesce(lost, F.lit(False)) | strays | broken | (~F.col("flow") & open_)
    put = put.withColumns({"bad": bad, "whole": whole})
    flows = F.transform(
        F.regexp_extract_all("whole", F.lit(_PAIR), F.lit(0)),
        lambda p: F.struct(F.regexp_extract(p, _PAIR, 1).alias("key"), F.trim(F.regexp_extract(p, _PAIR, 2)).alias("raw")),
    )
    one = F.array(F.struct(F.regexp_extract("head", r"^(\w+):", 1).alias("key"), F.col("raw").alias("raw")))
    rows = put.select(
        "file", "pack", "section_no", "item", "inner_no", "top", "bad", "more.text",
        F.explode(F.when(F.col("flow"), flows).otherwise(one)).alias("p"), "flow",
    )
    more = F.when(F.col("flow"), F.expr("cast(array() as array<string>)")).otherwise(F.col("text"))
    rows = rows.select(
        "file", "pack", "section_no", "item", "inner_no", "top", "bad", F.col("p.key").alias("key"),
        F.col("p.raw").alias("raw"), more.alias("more"),
    ).withColumn("folded", F.trim(F.concat_ws(" ", "raw", F.array_join("more", " "))))
    return rows.withColumn("value", _value(F.col("raw"), F.col("more")))


def question_rows(bodies: DataFrame) -> DataFrame:
    """The rows of question and answer files (pack, body) with a `part`: question, reading, answer, blocked,
    skipped_fixture, or unreadable for a file that is not of this shape (and then no other). A null or
    empty file has no rows."""
    pairs = _pairs(_numbered(_lines(bodies)))
    sections = Window.partitionBy("file", "section_no")
    files = Window.partitionBy("file")
    pairs = pairs.withColumn("section", F.max(F.when(F.col("top"), F.col("key"))).over(sections)).withColumn(
        "unreadable", F.max(F.col("bad") | F.col("section").isNull()).over(files))

    def of(key: str) -> Column:
        return F.max(F.when(F.col("key") == key, F.col("value")))

    wanted = ("id", "question_id", "fixture", "sentence_id", "subsection", "issue", "reading", "reason", "reading_id", "answered_by")
    good = pairs.where("not unreadable and not top and item > 0")
    items = good.groupBy("file", "pack", "section", "item", "inner_no").agg(*[of(k).alias(k) for k in wanted])
    around = Window.partitionBy("file", "section", "item")
    for name in ("id", "sentence_id"):
        items = items.withColumn(f"outer_{name}", F.max(F.when(F.col("inner_no") == 0, F.col(name))).over(around))
    none = F.lit(None).cast("string")

    def row(part: str, id_: str, sentence: str, text: str, reading: Column = none, by: Column = none) -> Column:
        return F.struct(
            F.lit(part).alias("part"), F.col(id_).alias("id"), F.col(sentence).alias("sentence_id"),
            F.col(text).alias("text"), reading.alias("reading_id"), by.alias("answered_by"),
        )

    outer = F.col("inner_no") == 0
    made = F.when((F.col("section") == "questions") & ~outer, row("reading", "outer_id", "outer_sentence_id", "reading", F.col("id")))
    for section, (part, *keys) in PARTS.items():
        extra = (F.col("reading_id"), F.col("answered_by")) if part == "answer" else ()
        made = made.when((F.col("section") == section) & outer, row(part, *keys, *extra))
    lost = pairs.where("unreadable").select("file", "pack").distinct().select(
        "pack", F.lit("unreadable").alias("part"), none.alias("id"), none.alias("sentence_id"),
        F.lit("not a file of questions and answers").alias("text"), none.alias("reading_id"), none.alias("answered_by"))
    rows = items.select("pack", made.alias("r")).where(F.col("r").isNotNull()).select("pack", "r.*")
    return rows.unionByName(lost)
