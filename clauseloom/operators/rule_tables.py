"""Decision tables as data: very many rows, joined with the facts instead of written into the plan.

A table is a DataFrame: `row_no` (its order, unique), an output, and per input a cell. A cell of a text
is `<input>_eq`, null for any. A cell of a number is `<input>_lo` and `<input>_hi`, null where it is not
bounded, with `<input>_lo_open` and `<input>_hi_open` where the bound itself does not count.

Rows meet facts by an equi-join. One number, the banded one, is cut into bands: a row's bands are as wide
as the power of two above its interval, so it lies in three at most, and a fact lies in one band of each
width that occurs. Texts that a row asks for are part of the key. So a fact offers one key for each kind
of row (which texts it asks for, which width its interval has) and meets only rows near it; every cell is
then tested. Kinds are few, whatever the number of rows: two for each text input, times the widths a
double can have. Without bounds the least and greatest of the facts stand in.

Pairs of facts and rows grow with the product of both, so the hit policies of a table of one number do
without them. Numbers are cut into slabs at quantiles. An interval is cut at the ends of its slabs: the
pieces at its ends go to their slab, where one task meets them with the different numbers of the facts, and
the whole slabs between are kept as nodes of a binary tree over the slabs, added up before they are met. What
comes out is one row per fact, texts asked for and share of a slab: how many rows hold, and the first of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clauseloom.operators.rows import catalogue

ANY_WIDTH = -5000  # rows that do not ask for the banded number; no width of a double is so small
PER_SLAB = 100_000  # numbers of a slab, bounds and facts together, on average
SLABS = 5_000  # at most


def _kind(texts: Sequence[str], band: str) -> tuple[Column, Column]:
    """(which texts a row asks for, as a number; the exponent of its band width)."""
    mask = sum((F.when(F.col(f"{t}_eq").isNotNull(), 1 << i).otherwise(0) for i, t in enumerate(texts)), F.lit(0))
    lo, hi = F.col("band_lo"), F.col("band_hi")
    # Below this width a double of that size could not be told from its neighbours.
    finest = F.floor(F.log2(F.greatest(F.abs(lo), F.abs(hi), F.lit(1.0)))) - 50
    wide = F.when(hi > lo, F.greatest(F.ceil(F.log2(hi - lo)), finest)).otherwise(finest)
    asked = F.col(f"{band}_lo").isNotNull() | F.col(f"{band}_hi").isNotNull()
    return mask.cast("int"), F.when(asked, wide).otherwise(ANY_WIDTH).cast("int")


def _texts(mask: Column, texts: Sequence[Column]) -> Column:
    """A hash of the texts that rows of this kind ask for."""
    return F.xxhash64(mask, *[F.when(mask.bitwiseAND(1 << i) > 0, t) for i, t in enumerate(texts)])


def _cells(texts: Sequence[str], numbers: Sequence[str]) -> Column:
    """Whether every cell of a row holds; a missing field decides no cell that asks for it."""
    test = F.lit(True)
    for t in texts:
        test = test & (F.col(f"t.{t}_eq").isNull() | F.coalesce(F.col(f"t.{t}_eq") == F.col(f"f.{t}"), F.lit(False)))
    for n in numbers:
        x = F.col(f"f.{n}")
        lo, hi = F.col(f"t.{n}_lo"), F.col(f"t.{n}_hi")
        low = F.when(F.coalesce(F.col(f"t.{n}_lo_open"), F.lit(False)), x > lo).otherwise(x >= lo)
        high = F.when(F.coalesce(F.col(f"t.{n}_hi_open"), F.lit(False)), x < hi).otherwise(x <= hi)
        test = test & (lo.isNull() | F.coalesce(low, F.lit(False))) & (hi.isNull() | F.coalesce(high, F.lit(False)))
    return test


def _exact(frame: DataFrame, *names: str) -> bool:
    """Whether numbers of these columns compare as doubles just as they do as they are."""
    kinds = [frame.schema[n].dataType for n in names]
    whole = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType, T.NullType)
    return all(isinstance(k, whole) or (isinstance(k, T.DecimalType) and k.precision <= 15) for k in kinds)


def _held(facts: pa.Table, rows: pa.Table) -> pa.Table:
    """Of the numbers `x` of one slab: how many of its rows hold, and the first of them."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[
        (c, "ascending") for c in ("row_no", "output") if not pa.types.is_nested(rows.schema.field(c).type)
    ], null_placement="at_start"))
    x = facts.column("x").to_numpy()
    order = np.argsort(x)
    x = x[order]
    lo, hi, lo_open, hi_open, n = (rows.column(c).to_numpy() for c in ("lo", "hi", "lo_open", "hi_open", "n"))
    left = np.where(lo_open, np.searchsorted(x, lo, "right"), np.searchsorted(x, lo))
    right = np.where(hi_open, np.searchsorted(x, hi), np.searchsorted(x, hi, "right"))
    some = np.flatnonzero(left < right)
    left, right = left[some], right[some]
    number = np.zeros(len(x) + 1, np.int64)
    np.add.at(number, left, n[some])
    np.subtract.at(number, right, n[some])
    number = np.cumsum(number[:-1])
    # Each interval is two overlapping ones whose length is a power of two, handed down to half of it.
    power = np.frexp((right - left).astype(np.float64))[1] - 1
    first = np.full(len(x), rows.num_rows, np.int64)
    for p in range(int(power.max(initial=0)), -1, -1):
        at = power == p
        np.minimum.at(first, left[at], some[at])
        np.minimum.at(first, right[at] - (1 << p), some[at])
        if p:
            half, above = 1 << (p - 1), first.copy()
            first[half:] = np.minimum(first[half:], above[:-half])
    hit = np.flatnonzero(number > 0)
    found, best = facts.take(pa.array(order[hit])), rows.take(pa.array(first[hit]))
    return found.append_column("__n", pa.array(number[hit])).append_column(
        "row_no", best.column("row_no")).append_column("output", best.column("output"))


def _counted(facts: DataFrame, table: DataFrame, key: str, texts: Sequence[str], number: str,
             output: str) -> DataFrame:
    """(key, row_no, output, __n) as told for `matches`, of a table of one number."""
    kind = [f"a{i}" for i in range(len(texts))]
    lo, hi = F.col(f"{number}_lo").cast("double"), F.col(f"{number}_hi").cast("double")
    mask = sum((F.when(F.col(f"{t}_eq").isNotNull(), 1 << i).otherwise(0) for i, t in enumerate(texts)), F.lit(0))

    def is_open(side: str) -> Column:
        return F.col(f"{number}_{side}").isNotNull() & F.coalesce(F.col(f"{number}_{side}_open"), F.lit(False))

    rows = table.select(
        mask.cast("int").alias("mask"), *(F.col(f"{t}_eq").alias(k) for t, k in zip(texts, kind)), lo.alias("lo"),
        hi.alias("hi"), is_open("lo").alias("lo_open"), is_open("hi").alias("hi_open"), "row_no",
        F.col(output).alias("output"),
    )
    masks = sorted(r["mask"] for r in rows.select("mask").distinct().collect())
    offered = F.array(*[
        F.struct(F.lit(m).alias("mask"), *(
            F.when(F.lit(bool(m >> i & 1)), F.col(t)).alias(k) for i, (t, k) in enumerate(zip(texts, kind))
        )) for m in masks
    ]) if masks else F.lit(None).cast("array<struct<mask:int," + ",".join(
        f"{k}:{facts.schema[t].dataType.simpleString()}" for t, k in zip(texts, kind)) + ">>")
    offers = facts.select(F.col(key).alias("key"), F.col(number).cast("double").alias("x"), F.explode(offered).alias("o"))
    offers = offers.select("key", "x", "o.*")
    for i, k in enumerate(kind):  # a missing text decides no cell that asks for it
        offers = offers.where((F.col("mask").bitwiseAND(1 << i) == 0) | F.col(k).isNotNull())

    # Slabs: 0 to top - 1 by the quantiles, top for what is no number, -1 for a missing one.
    ends = rows.select(F.explode(F.array("lo", "hi")).alias("x")).unionByName(facts.select(
        F.col(number).cast("double").alias("x"))).where("x > double('-inf') and x < double('inf')")
    many = min(SLABS, ends.count() // PER_SLAB + 1)
    cut = ends.agg(F.percentile_approx("x", [i / many for i in range(1, many)], 10 * many)).first()[0] if many > 1 else None
    times = Counter(cut or [0.0])
    splits = sorted(times)
    top = len(splits) + 1
    # A number so frequent that it is several quantiles has a slab of its own in as many shares.
    shares = F.element_at(F.array(*map(F.lit, [1, *(times[x] for x in splits), 1])), F.col("slab").cast("int") + 1)

    def slabs(frame: DataFrame, **named: str) -> DataFrame:
        return Bucketizer(
            inputCols=list(named.values()), outputCols=list(named), handleInvalid="keep",
            splitsArray=[[-float("inf"), *splits, float("inf")]] * len(named),
        ).transform(frame).withColumns({c: F.col(c).cast("int") for c in named})

    numbers = slabs(offers.select("mask", *kind, "x").distinct(), slab="x").withColumn("slab", F.coalesce("slab", F.lit(-1)))
    placed = slabs(rows, i="lo", j="hi").where("i is null or j is null or i <= j")
    least, most = F.lit(-float("inf")), F.lit(float("nan"))

    def piece(when: str, slab: str, lo: Column, hi: Column, lo_open: Column, hi_open: Column) -> Column:
        return F.when(F.expr(when), F.struct(
            F.col(slab).alias("slab"), lo.alias("lo"), hi.alias("hi"), lo_open.alias("lo_open"), hi_open.alias("hi_open")
        ))

    no, one = F.lit(False), ("row_no", "output")
    pieces = placed.select("mask", *kind, *one, F.explode(F.array(
        piece("i = j", "i", F.col("lo"), F.col("hi"), F.col("lo_open"), F.col("hi_open")),
        piece("i < j or j is null", "i", F.col("lo"), most, F.col("lo_open"), no),
        piece("i < j or i is null", "j", least, F.col("hi"), no, F.col("hi_open")),
    )).alias("p")).select("mask", *kind, *one, "p.*").where("slab is not null")
    pieces = pieces.withColumns({"share": F.pmod(F.xxhash64("row_no", "lo", "hi"), shares), "n": F.lit(1).cast("long")})

    # Whole slabs: nodes of level k are runs of 2^k slabs; one whose parent is whole, too, is left out.
    levels = range(top.bit_length() + 1)
    nodes = [F.when(F.col("lo").isNull() & F.col("hi").isNull(), F.struct(F.lit(0).alias("level"), F.lit(-1).alias("node")))]
    for k in levels:
        low = F.floor((F.col("l") + ((1 << k) - 1)) / (1 << k)).cast("int")
        high = (F.floor((F.col("r") + 1) / (1 << k)) - 1).cast("int")
        for at, odd in ((low, 1), (high, 0)):
            nodes.append(F.when((low <= high) & (F.pmod(at, F.lit(2)) == odd),
                                F.struct(F.lit(k).alias("level"), at.alias("node"))))
    whole = placed.withColumns({"l": F.coalesce(F.col("i") + 1, F.lit(0)), "r": F.coalesce(F.col("j") - 1, F.lit(top))})
    whole = whole.where("l <= r").select("mask", *kind, *one, F.explode(F.array(*nodes)).alias("t"))
    whole = whole.where("t is not null").groupBy("mask", *kind, "t.level", "t.node").agg(
        F.count("*").alias("n"), F.min(F.struct(*one)).alias("best"))
    above = numbers.select("mask", *kind, "slab").distinct().select(
        "*", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    above = above.withColumn("node", F.floor(F.col("slab") / F.pow(F.lit(2.0), "level")).cast("int")).where(
        "slab >= 0 or level = 0").alias("f")
    same = F.lit(True)
    for c in ("mask", *kind, "level", "node"):
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"t.{c}"))
    above = above.join(whole.alias("t"), same).groupBy(*(F.col(f"f.{c}") for c in ("mask", *kind, "slab"))).agg(
        F.sum("n").alias("n"), F.min("best").alias("best"))
    above = above.select("mask", *kind, "best.*", "slab", least.alias("lo"), most.alias("hi"), no.alias("lo_open"),
                         no.alias("hi_open"), F.lit(0).cast("long").alias("share"), "n")

    numbers = numbers.select("*", F.explode(F.when(F.col("slab") < 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.when(F.col("slab") >= 0, shares - 1)))).alias("share"))
    schema = numbers.select("*", F.lit(0).cast("long").alias("__n")).schema
    schema = T.StructType([*schema.fields, pieces.schema["row_no"], pieces.schema["output"]])
    group = ("mask", *kind, "slab", "share")
    empty = to_arrow_schema(schema).empty_table()

    def held(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            return _held(left, right).select(empty.column_names)
        return empty

    found = numbers.groupBy(*group).cogroup(pieces.unionByName(above).groupBy(*group)).applyInArrow(held, schema)
    met = F.lit(True)
    for c in ("mask", *kind, "x"):
        met = met & F.col(f"f.{c}").eqNullSafe(F.col(f"t.{c}"))
    return offers.alias("f").join(found.alias("t"), met).select(
        F.col("f.key").alias(key), "t.row_no", F.col("t.output").alias(output), "t.__n")


def matches(facts: DataFrame, table: DataFrame, key: str, texts: Sequence[str], numbers: Sequence[str],
            output: str, band: str | None = None, counted: bool = False) -> DataFrame:
    """(key, row_no, output): every row of the table that holds for a fact. `band` is the number to cut by,
    the first if none is named.

    `counted`, for a table of one number: rows that hold for a fact are added up, not paired with it. Each row
    then stands for `__n` rows that hold, of which it is the first by row_no and output."""
    if counted and len(numbers) == 1 and _exact(facts, numbers[0]) and _exact(table, f"{numbers[0]}_lo", f"{numbers[0]}_hi"):
        return _counted(facts, table, key, texts, numbers[0], output)
    band = band or numbers[0]
    ends = facts.agg(F.min(band).cast("double").alias("lo"), F.max(band).cast("double").alias("hi")).first()
    least, most = (ends.lo if ends.lo is not None else 0.0), (ends.hi if ends.hi is not None else 0.0)
    bounded = table.withColumns({
        "band_lo": F.coalesce(F.col(f"{band}_lo").cast("double"), F.least(F.lit(least), F.col(f"{band}_hi").cast("double"), F.lit(most))),
        "band_hi": F.coalesce(F.col(f"{band}_hi").cast("double"), F.greatest(F.lit(most), F.col(f"{band}_lo").cast("double"), F.lit(least))),
    }).where("band_lo <= band_hi")
    mask, width = _kind(texts, band)
    kinded = bounded.withColumns({"mask": mask, "width": width})

    def place(x: Column, exponent: Column) -> Column:
        return F.floor(x / F.pow(F.lit(2.0), exponent)).try_cast("long")

    asked = F.col("width") != ANY_WIDTH
    low, high = place(F.col("band_lo"), F.col("width")), place(F.col("band_hi"), F.col("width"))
    places = F.when(asked, F.sequence(low, high)).otherwise(F.array(F.lit(0).cast("long")))
    rows = kinded.withColumn("place", F.explode(places))
    rows = rows.withColumn("asked", _texts(F.col("mask"), [F.col(f"{t}_eq") for t in texts]))
    kinds = [(r["mask"], r["width"]) for r in kinded.select("mask", "width").distinct().collect()]
    if not kinds:
        return facts.limit(0).select(key, F.lit(None).cast(table.schema["row_no"].dataType).alias("row_no"),
                                     F.lit(None).cast(table.schema[output].dataType).alias(output))
    offered = F.array(*[
        F.struct(
            F.lit(m).alias("mask"), F.lit(w).alias("width"), _texts(F.lit(m), [F.col(t) for t in texts]).alias("asked"),
            (F.lit(0).cast("long") if w == ANY_WIDTH else place(F.col(band).cast("double"), F.lit(float(w)))).alias("place"),
        )
        for m, w in kinds
    ])
    offers = facts.select(key, *texts, *numbers, F.explode(offered).alias("__offer")).alias("f")
    # A fact has one place in each kind and a row has one kind, so no pair is met twice.
    same = [F.col(f"f.__offer.{c}") == F.col(f"t.{c}") for c in ("mask", "width", "asked", "place")]
    met = offers.join(catalogue(rows).alias("t"), same)
    return met.where(_cells(texts, numbers)).select(F.col(f"f.{key}").alias(key), "t.row_no", F.col(f"t.{output}").alias(output))


def hit_policies(facts: DataFrame, found: DataFrame, key: str, output: str) -> DataFrame:
    """(key, n_hits, violation, first_row, first, only) per fact, of what `matches` found: the first row
    that holds and its output, and the output where no more than one row holds. Minima and counts combine
    before the shuffle; no list of rows is collected."""
    number = F.sum("__n") if "__n" in found.columns else F.count("*")
    best = found.groupBy(key).agg(number.alias("n"), F.min(F.struct("row_no", output)).alias("best"))
    n = F.coalesce("n", F.lit(0))
    return facts.select(key).join(best, key, "left").select(
        key, n.alias("n_hits"), (n > 1).alias("violation"), F.col("best.row_no").alias("first_row"),
        F.col(f"best.{output}").alias("first"), F.when(n == 1, F.col(f"best.{output}")).alias("only"),
    )
