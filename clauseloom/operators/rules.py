"""Loans to verdicts: derived fields, decision rows, folds.

The whole path is row-wise: no shuffle between the loan scan and the verdict rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clauseloom.functions.dates import open_days_sql
from clauseloom.functions.names import subsection_key
from clauseloom.model import FAIL, NOT_APPLICABLE, PASS, DaySet, Derived, Pack
from clauseloom.operators.rows import value_rows

HIT_TYPE = "array<struct<rule_id:string,result:string>>"


def day_set_sql(spec: DaySet) -> str:
    """A day set as Spark SQL."""
    lo = f"date_sub({spec.start}, {spec.pad_days})"
    hi = f"date_add({spec.end}, {spec.pad_days})"
    days = open_days_sql(lo, hi, spec.closed_weekday, spec.excluded)
    return f"filter({days}, day -> {spec.test})" if spec.test else days


def _formula(spec: DaySet | Derived) -> Column:
    return F.expr(day_set_sql(spec) if isinstance(spec, DaySet) else spec.expression)


def with_derived(loans: DataFrame, pack: Pack) -> DataFrame:
    """The loans with a `derived` struct, one field per derived value, in dependency order."""
    out, done = loans, []
    for spec in pack.in_order():
        kept = [F.col(f"derived.{name}").alias(name) for name in done]
        out = out.withColumn("derived", F.struct(*kept, _formula(spec).alias(spec.name)))
        done.append(spec.name)
    return out


def with_decisions(loans: DataFrame, pack: Pack, keep: Iterable[str] = ("loan_id",)) -> DataFrame:
    """`keep`, `derived`, and per rule i the nullable booleans `applies_i` and `met_i`.

    A requirement is one column, so the pass row and the fail row cannot drift and the
    interpreted lambdas inside it run once per loan.
    """
    cells = [
        column
        for i, r in enumerate(pack.rules)
        for column in (
            F.expr(r.applies_when).alias(f"applies_{i}"),
            F.expr(r.requirement).alias(f"met_{i}"),
        )
    ]
    return with_derived(loans, pack).select(*keep, "derived", *cells)


def decision_rows(cells: DataFrame, pack: Pack, keep: Iterable[str]) -> DataFrame:
    """One row per loan and rule: (keep, rule_id, applies, met).

    The array stands inside the explode: over a computed column Catalyst infers a `size > 0`
    filter and would compute every rule twice.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.col(f"applies_{i}").alias("applies"),
                F.col(f"met_{i}").alias("met"),
            )
            for i, r in enumerate(pack.rules)
        ]
    )
    return cells.select(*keep, F.explode(rows).alias("c")).select(*keep, "c.*")


def verdict(applies: Column, met: Column) -> Column:
    """Two rows of a decision table: a null in either cell fires neither."""
    return F.when(applies & met, PASS).when(applies & ~met, FAIL)


def evaluate(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """One row per rule that fires: (key, rule_id, result)."""
    return fired(with_decisions(loans, pack, (key,)), pack, (key,))


def fired(cells: DataFrame, pack: Pack, keep: Iterable[str] = ("loan_id",)) -> DataFrame:
    """Verdict rows of decided cells."""
    rows = decision_rows(cells, pack, keep)
    return rows.select(
        *keep, "rule_id", verdict(F.col("applies"), F.col("met")).alias("result")
    ).where(F.col("result").isNotNull())


def collect_hits(loans: DataFrame, pack: Pack, keep: Iterable[str] = ("loan_id",)) -> DataFrame:
    """One row per loan and paragraph, `hits` holding every row that matched, empty when none."""
    by_paragraph = [
        F.struct(F.lit(p).alias("subsection"), _hits(pack, p).alias("hits"))
        for p in paragraphs(pack)
    ]
    cells = with_decisions(loans, pack, keep)
    return cells.select(*keep, F.explode(F.array(*by_paragraph)).alias("p")).select(*keep, "p.*")


def paragraphs(pack: Pack) -> list[str]:
    return list(dict.fromkeys(r.subsection for r in pack.rules))


def _hits(pack: Pack, paragraph: str) -> Column:
    rows = []
    for i, r in enumerate(pack.rules):
        if r.subsection == paragraph:
            result = verdict(F.col(f"applies_{i}"), F.col(f"met_{i}"))
            row = F.struct(F.lit(r.rule_id).alias("rule_id"), result.alias("result"))
            rows.append(F.when(result.isNotNull(), row))
    return F.array_compact(F.array(*rows)).cast(HIT_TYPE)


def fold_hits(hits: Column) -> Column:
    """A paragraph's verdict: nothing fired, any fail, else pass."""
    return (
        F.when(F.size(hits) == 0, NOT_APPLICABLE)
        .when(F.exists(hits, lambda h: h["result"] == FAIL), FAIL)
        .otherwise(PASS)
    )


def subsection_verdicts(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """(key, subsection, verdict) for every loan and paragraph, folded inside the row."""
    return collect_hits(loans, pack, (key,)).select(
        key, "subsection", fold_hits(F.col("hits")).alias("verdict")
    )


def fold_verdict_rows(
    loans: DataFrame, verdicts: DataFrame, pack: Pack, key: str = "loan_id"
) -> DataFrame:
    """The same fold over verdict rows that were stored.

    Every loan brings one empty row per paragraph, so a loan without verdicts is still there and
    one grouping does the work of a join. Maxima combine before the shuffle.
    """
    slots = loans.select(
        key,
        F.explode(F.array(*[F.lit(p) for p in paragraphs(pack)])).alias("subsection"),
        F.lit(None).cast("int").alias("failed"),
    )
    paragraph_of = F.create_map(*[F.lit(x) for r in pack.rules for x in (r.rule_id, r.subsection)])
    fired = verdicts.select(
        key,
        paragraph_of[F.col("rule_id")].alias("subsection"),
        (F.col("result") == FAIL).cast("int").alias("failed"),
    ).where(F.col("subsection").isNotNull())
    folded = slots.unionByName(fired).groupBy(key, "subsection").agg(F.max("failed").alias("failed"))
    return folded.select(
        key,
        "subsection",
        F.when(F.col("failed").isNull(), NOT_APPLICABLE)
        .when(F.col("failed") == 1, FAIL)
        .otherwise(PASS)
        .alias("verdict"),
    )


def undecided(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """(key, rule_id, cell) for each cell that does not decide: its row can never match, and
    without this report nobody would notice."""
    rows = decision_rows(with_decisions(loans, pack, (key,)), pack, (key,))
    return value_rows(
        rows,
        [key, "rule_id"],
        "cell",
        F.when(F.col("applies").isNull(), "applies_when"),
        F.when(F.col("met").isNull(), "requirement"),
    )


def missing_receipt(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """Loans whose receipt date cannot be derived: the general rule fails them, the timeshare
    rule says nothing, so they are reported apart."""
    missing = F.when(F.col("derived.cd_receipt_date").isNull(), "derived.cd_receipt_date")
    return value_rows(with_derived(loans, pack), [key], "field", missing)


def result_document(loans: DataFrame, pack: Pack, key: str = "loan_id") -> DataFrame:
    """(key, document): results per paragraph key and derived values, as one JSON text."""
    results = F.struct(*[_hits(pack, p).alias(_key_of(p)) for p in paragraphs(pack)])
    document = F.struct(results.alias("results"), F.col("derived"))
    return with_decisions(loans, pack, (key,)).select(key, F.to_json(document).alias("document"))


def _key_of(label: str) -> str:
    """The paragraph key as a column name: it names a field, so it is needed at plan time."""
    return "s" + re.sub("[^A-Za-z0-9]+", "_", label).strip("_")


def rules_frame(spark, pack: Pack) -> DataFrame:
    """The catalogue of a pack as rows: (rule_id, subsection, subsection_key)."""
    rows = [(r.rule_id, r.subsection) for r in pack.rules]
    frame = spark.createDataFrame(rows, "rule_id string, subsection string")
    return frame.withColumn("subsection_key", subsection_key(F.col("subsection")))


def verdict_summary(loans: DataFrame, pack: Pack) -> DataFrame:
    """Verdict counts per rule, delivery method and in total.

    Counts per (rule, method, result) first; the totals roll up from those few rows.
    """
    flat = loans.withColumn("delivery_method", F.col("cd.delivery_method"))
    keep = ("delivery_method",)
    rows = fired(with_decisions(flat, pack, keep), pack, keep)
    base = rows.groupBy("rule_id", "delivery_method", "result").agg(F.count("*").alias("n"))
    return base.rollup("rule_id", "delivery_method", "result").agg(F.sum("n").alias("n_verdicts"))
