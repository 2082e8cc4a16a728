"""Personal data in whole texts by bootstrapped contextual extraction, in DataFrame functions only.

Base spans of four kinds come from fixed patterns. They are the seeds. A lexical pattern is the word
before, the word after, or both; a mention has up to three of them. Candidates are runs of
neighbouring groups of digits, and every other token with a digit or an at sign, that could be of a
kind and are no base spans. Patterns and instances (the texts of entities and candidates) make a
graph that is scored in turns:

- a pattern's confidence in a kind is the share of its mentions that belong to instances believed to
  be of the kind; it counts once `support` different instances are believed for certain;
- a candidate in a pattern of high confidence is believed for certain from then on, so what a pattern
  discovers supports the patterns of the next turn; any other is believed as far as its patterns
  with support are on average, times `DAMPING`, so that doubt does not grow into belief by repetition.

Candidates in patterns of high confidence after the last turn are added, each as the kind its patterns are surest of
(equal: the first as listed). Base spans always stay.

A pattern is hot where its words are frequent: mentions are counted per pattern and instance before
anything is joined, all sums are partial aggregates, and joins are plain equi-joins that can be split.

Offsets are in code points. They come from splitting the text at the matches: the pieces between
and the matches add up. The patterns are written so that no match is tried twice at one place
(possessive loops, looks behind), with the same matches as the plain patterns they stand for.

Cases: null text is empty; a row each for null, repeated and empty ones. A mention at an end of the text, or next
to marks only, has fewer patterns. No seeds: nothing is added. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.llm.shared import written

KINDS = ("email", "ip", "card", "phone")
TURNS, SUPPORT, CONFIDENCE = 4, 3, 0.8
DAMPING = 0.75  # of the belief in a candidate that no pattern of high confidence holds

# Fixed patterns; each stands for the plain one of the contract.
FIND = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# A whole run of neighbouring groups of 7 to 19 digits; no part of a longer one, nor four parts with dots.
RUN = (
    r"(?<![^\x20\x09-\x0D])(?<![0-9)]\x20)(?![0-9]++(?:[.:,][0-9]++){3})"
    r"\(?(?:[0-9][()./_\x20-]*+){7,19}+(?![0-9*@])(?:(?<=\x20)|(?![\p{L}\p{N}]))"
)
CANDIDATE = f"{RUN}|{TOKEN}"
BLANKS = "\t\n\x0b\x0c\r"
MARKS_BEFORE = r"^(?:(?!\([0-9]+\))[^\p{L}\p{N}+@])+"  # but the bracket of an area code
MARKS_AFTER = r"[^\p{L}\p{N}]+$"


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value):
    """Whether the digits pass Luhn's test; every second from the right is doubled."""
    turned = F.reverse(_digits(value))

    def one(total, i):
        d = F.ascii(F.substring(turned, i, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), one) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(16, 19), _luhn(v)).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}
# What a candidate must look like to be of a kind at all.
POSSIBLE = {
    "email": lambda v: v.rlike(r"^[^@]+@[^@]+$"),
    "ip": lambda v: v.rlike(r"^[0-9]+(?:[.:,][0-9]+){3}$"),
    "card": lambda v: v.rlike(r"^[0-9*xX./_\x20-]+$") & F.length(_digits(v)).between(12, 19),
    "phone": lambda v: v.rlike(r"^[0-9()./_\x20-]+$") & F.length(_digits(v)).between(7, 15)
    & ~v.rlike(r"^[0-9]+(?:\.[0-9]+)+$"),
}


SPANS = "array<struct<start:int,end:int,left:string,right:string,value:string>>"


def _starts(pieces: str, hits: str):
    """Where the matches begin: the pieces between them and the matches before add up."""
    none = F.array().cast("array<int>")

    def begin(state, i):
        start = state["at"] + F.length(F.get(pieces, i))
        return F.struct(
            (start + F.length(F.get(hits, i))).alias("at"),
            F.concat(state["starts"], F.array(start)).alias("starts"),
        )

    places = F.sequence(F.lit(0), F.size(hits) - 1)
    begun = F.struct(F.lit(0).alias("at"), none.alias("starts"))
    return F.when(
        F.size(hits) > 0, F.aggregate(places, begun, begin, lambda s: s["starts"])
    ).otherwise(none)


def _blank(piece):
    return F.translate(piece, BLANKS, " " * len(BLANKS))


def _spans(pieces: str, hits: str, starts: str):
    def span(start, i):
        value = F.get(hits, i)
        return F.struct(
            start.alias("start"), (start + F.length(value)).alias("end"),
            F.substring_index(F.rtrim(_blank(F.get(pieces, i))), " ", -1).alias("left"),
            F.substring_index(F.ltrim(_blank(F.get(pieces, i + 1))), " ", 1).alias("right"),
            value.alias("value"),
        )

    return F.transform(starts, span)


def _valid(kind: str):
    return lambda s: VALID[kind](s["value"])


def found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: key, row, an array of base spans per kind, and the candidates.

    Each step is a projection of its own, as an expression inside a lambda is worked out for
    every element.
    """
    body = F.col("body")
    looks = {
        "email": body.contains("@"), "ip": body.rlike(r"[0-9]\.[0-9]"),
        "card": body.rlike("[0-9][0-9 -]{14}"), "phone": body.contains("+"),
        "tokens": body.rlike("[0-9@]"),
    }
    patterns = FIND | {"tokens": CANDIDATE}
    none = F.array().cast("array<string>")
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.select("key", "row", *(
        column for k, p in patterns.items() for column in (
            F.when(looks[k], F.split(body, p, -1)).otherwise(none).alias(f"{k}_pieces"),
            F.when(looks[k], F.regexp_extract_all(body, F.lit(p), F.lit(0))).otherwise(none)
            .alias(f"{k}_hits"),
        )
    ))
    rows = rows.select("*", *(_starts(f"{k}_pieces", f"{k}_hits").alias(f"{k}_starts") for k in patterns))
    rows = rows.select("key", "row", *(
        _spans(f"{k}_pieces", f"{k}_hits", f"{k}_starts").cast(SPANS).alias(k) for k in patterns
    ))
    return written(
        rows.select("key", "row", *(F.filter(k, _valid(k)).alias(k) for k in KINDS), "tokens"), "spans"
    )


def _patterns(left, right):
    """The patterns of a mention: its two neighbouring words, and each by itself."""
    def word(side):
        return F.lower(F.regexp_replace(F.regexp_replace(side, MARKS_BEFORE, ""), MARKS_AFTER, ""))

    a, b = word(left), word(right)
    return F.filter(
        F.array(
            F.when((a != "") & (b != ""), F.concat_ws("\x01", F.lit("both"), a, b)),
            F.when(a != "", F.concat_ws("\x01", F.lit("left"), a)),
            F.when(b != "", F.concat_ws("\x01", F.lit("right"), b)),
        ),
        lambda p: p.isNotNull(),
    )


def mentions(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seeds, candidates): row, kind, start, end, patterns, value, first.

    A candidate that could be of several kinds has a row for each; `first` holds for one of them.
    """
    seeds = None
    for kind in KINDS:
        one = base.where(F.size(kind) > 0).select("row", F.explode(kind).alias("s"), F.lit(kind).alias("kind"))
        seeds = one if seeds is None else seeds.unionByName(one)
    seeds = seeds.select(
        "row", "kind", "s.start", "s.end", _patterns("s.left", "s.right").alias("patterns"), "s.value",
        F.lit(True).alias("first"),
    )
    taken = F.concat(*(F.transform(k, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))) for k in KINDS))
    free = F.filter(
        "tokens",
        lambda t: ~F.exists(taken, lambda s: (s["a"] < t["end"]) & (t["start"] < s["b"])),
    )
    tokens = base.where(F.size("tokens") > 0).select("row", F.explode_outer(free).alias("s")).where("s is not null")
    cut = tokens.select(
        "row", "s.start", "s.left", "s.right",
        F.regexp_extract("s.value", MARKS_BEFORE, 0).alias("before"),
        F.regexp_replace(F.regexp_replace("s.value", MARKS_BEFORE, ""), MARKS_AFTER, "").alias("value"),
    )
    kinds = F.filter(
        F.array(*(F.when(POSSIBLE[k](F.col("value")), F.lit(k)) for k in KINDS)), lambda k: k.isNotNull()
    )
    candidates = cut.withColumn("kinds", kinds).select(
        "row", F.explode_outer("kinds").alias("kind"),
        (F.col("start") + F.length("before")).cast("int").alias("start"),
        (F.col("start") + F.length("before") + F.length("value")).cast("int").alias("end"),
        _patterns("left", "right").alias("patterns"), "value", F.get("kinds", F.lit(0)).alias("one"),
    ).where("kind is not null")
    return seeds, candidates.withColumn("first", F.col("kind") == F.col("one")).drop("one")


def confident(seeds: DataFrame, candidates: DataFrame, turns: int, support: int,
              confidence: float) -> DataFrame:
    """(pattern, kind, confidence) of high confidence, from the scored graph of patterns and instances."""
    def edges(frame, seed):
        each = frame.select("kind", "value", "first", F.explode_outer("patterns").alias("pattern"))
        return each.where("pattern is not null").groupBy("pattern", "kind", "value").agg(
            F.count("*").alias("n"), F.count_if("first").alias("mentions")
        ).withColumn("seed", F.lit(seed))

    graph = written(edges(seeds, 1.0).unionByName(edges(candidates, 0.0)), "graph")
    # A candidate that could be of two kinds is one mention of its patterns.
    whole = written(graph.groupBy("pattern").agg(F.sum("mentions").alias("all")), "mentions")
    believed = graph.withColumn("belief", F.col("seed"))
    for turn in range(turns):
        of_pattern = believed.groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("belief")).alias("sum"),
            F.count_if(F.col("belief") >= 1).alias("known"),
        )
        scored = written(
            of_pattern.where(F.col("known") >= support).join(whole, "pattern")
            .select("pattern", "kind", F.round(F.col("sum") / F.col("all"), 9).alias("confidence")),
            "patterns",
        )
        if turn + 1 < turns:
            held = graph.where("seed = 0").join(scored, ["pattern", "kind"], "left")
            marks = held.groupBy("kind", "value").agg(
                F.max("confidence").alias("best"),
                (F.sum(F.col("n") * F.col("confidence")) / F.sum(F.when(F.col("confidence").isNotNull(), F.col("n"))))
                .alias("mean"),
            ).where("best is not null")  # patterns without support tell nothing
            belief = F.when(F.col("best") >= confidence, 1.0).otherwise(DAMPING * F.col("mean"))
            believed = graph.join(marks, ["kind", "value"], "left").select(
                *(F.col(c) for c in graph.columns), F.greatest("seed", F.coalesce(belief, F.lit(0.0))).alias("belief")
            )
    return scored.where(F.col("confidence") >= confidence)


def _added(candidates: DataFrame, good: DataFrame) -> DataFrame:
    """(row, added): the candidates in good patterns, each of one kind, as many as one text has."""
    places = candidates.select("row", "start", "end", "kind", F.explode_outer("patterns").alias("pattern"))
    order = F.when(F.col("kind") == KINDS[0], 0)
    for nth, kind in enumerate(KINDS[1:], 1):
        order = order.when(F.col("kind") == kind, -nth)
    surest = places.join(good, ["pattern", "kind"]).groupBy("row", "start", "end").agg(
        F.max_by("kind", F.struct("confidence", order.alias("order"))).alias("kind")
    )
    return surest.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text", turns: int = TURNS,
            support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: key, n_<kind> (base spans), base_sha256, spans, n_added."""
    base = found(docs, key, text)
    seeds, candidates = mentions(base)
    candidates = written(candidates, "candidates")
    good = confident(seeds, candidates, turns, support, confidence)
    added = _added(candidates, good)

    def named(kind, spans):
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def with_added(kind):
        own = F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        more = F.transform(
            F.filter(F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")),
                     lambda s: s["kind"] == kind),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
        )
        return named(kind, F.array_sort(F.concat(own, more)))

    return base.join(added, "row", "left").select(
        F.col("key").alias(key),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(F.concat(*(named(k, F.col(k)) for k in KINDS)), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*(with_added(k) for k in KINDS)), ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"),
    )
