"""Decision tables over facts: field-bound cells and the hit policies first, unique, collect.

A table is a page of rows written by people. It becomes one expression over the facts, so a hit
policy is a projection: no join, no shuffle, whatever the number of facts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CELL = re.compile(r"^(<=|>=|!=|<|>|=)?\s*(.+)$", re.DOTALL)


def cell_predicate(field: Column, cell: str) -> Column:
    """One cell: a literal the field equals, a comparison such as `>= 100`, or empty / `-` for
    any value. Numbers are bare, texts are in double quotes."""
    cell = cell.strip()
    if cell in ("", "-"):
        return F.lit(True)
    sign, operand = _CELL.match(cell).groups()
    operand = operand.strip()
    value = F.lit(operand[1:-1]) if operand.startswith('"') else F.lit(float(operand))
    compare = {
        "<": field < value,
        "<=": field <= value,
        ">": field > value,
        ">=": field >= value,
        "!=": field != value,
    }
    return compare.get(sign, field == value)


def row_predicates(inputs: Mapping[str, str], rows: Sequence[Mapping[str, str]]) -> list[Column]:
    """Per table row, whether every cell holds. `inputs` maps a cell column to the fact's field.
    A missing field decides no cell that asks for it."""
    out = []
    for row in rows:
        test = F.lit(True)
        for column, field in inputs.items():
            test = test & cell_predicate(F.col(field), row.get(column, ""))
        out.append(F.coalesce(test, F.lit(False)))
    return out


def first_hit(
    facts: DataFrame, inputs: Mapping[str, str], rows: Sequence[Mapping], output: str, name: str
) -> DataFrame:
    """The facts with the output of the first row that matches, null when none does."""
    picked = F.coalesce(
        *[F.when(p, F.lit(r[output])) for p, r in zip(row_predicates(inputs, rows), rows)]
    )
    return facts.withColumn(name, picked)


def collect_rows(
    facts: DataFrame, inputs: Mapping[str, str], rows: Sequence[Mapping], output: str, name: str
) -> DataFrame:
    """The facts with the outputs of all rows that match, in table order."""
    hits = [F.when(p, F.lit(r[output])) for p, r in zip(row_predicates(inputs, rows), rows)]
    return facts.withColumn(name, F.array_compact(F.array(*hits)))


def unique_hit(
    facts: DataFrame, inputs: Mapping[str, str], rows: Sequence[Mapping], output: str, name: str
) -> DataFrame:
    """The facts with the output of the only row that matches, `n_hits`, and `violation` where
    more than one does; then the output is null."""
    predicates = row_predicates(inputs, rows)
    n_hits = sum((p.cast("int") for p in predicates), F.lit(0))
    picked = F.coalesce(*[F.when(p, F.lit(r[output])) for p, r in zip(predicates, rows)])
    counted = facts.withColumn("n_hits", n_hits)
    return counted.withColumn("violation", F.col("n_hits") > 1).withColumn(
        name, F.when(F.col("n_hits") == 1, picked)
    )
