"""Defects injected by plain projections.

A defect replaces one column where a condition holds. Conditions and values are SQL expressions over
the clean row, so injection is a single ``select`` at any scale. Where several defects of a column
apply, the first wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.metrics import rows_of


@dataclass(frozen=True)
class Defect:
    name: str
    column: str
    where: str
    value: str


def _of_column(defects: Sequence[Defect], column: str) -> list[Defect]:
    return [d for d in defects if d.column == column]


def inject_defects(df: DataFrame, defects: Sequence[Defect]) -> DataFrame:
    types = {field.name: field.dataType.simpleString() for field in df.schema}

    def damaged(column: str) -> str:
        cases = [
            f"WHEN {d.where} THEN CAST({d.value} AS {types[column]})"
            for d in _of_column(defects, column)
        ]
        return f"CASE {' '.join(cases)} ELSE `{column}` END AS `{column}`" if cases else f"`{column}`"

    return df.selectExpr(*[damaged(c) for c in df.columns])


def defect_summary(df: DataFrame, table_name: str, defects: Sequence[Defect]) -> DataFrame:
    """How many rows of the clean table each defect hits."""

    def hits(defect: Defect) -> Column:
        same = _of_column(defects, defect.column)
        condition = F.coalesce(F.expr(defect.where), F.lit(False))
        for earlier in same[: same.index(defect)]:
            condition = condition & ~F.coalesce(F.expr(earlier.where), F.lit(False))
        return condition

    counts = df.agg(*[F.count_if(hits(d)).alias(f"n_{i}") for i, d in enumerate(defects)])
    return rows_of(
        counts,
        [
            {
                "table_name": F.lit(table_name),
                "defect": F.lit(d.name),
                "row_count": F.col(f"n_{i}"),
            }
            for i, d in enumerate(defects)
        ],
    )
