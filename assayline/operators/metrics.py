"""Metrics and reports as DataFrames: one aggregate per table, unpivoted to rows.

Duplicate and orphan counts come from per-key counts that combine before the shuffle; no row-level
flag is needed to know them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.functions import classify, rules
from assayline.operators import checks, keys
from assayline.operators.lookup import Lookup, key_counts, key_presence
from assayline.specs import ForeignKey, Rule, TableSpec


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def rows_of(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Unpivot a one-row aggregate into the given rows."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def completeness_metrics(df: DataFrame, table_name: str, fields: Sequence[str]) -> DataFrame:
    """Rows, NULLs and pass percentage of each field."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in fields],
    )
    return rows_of(
        totals,
        [
            {
                "table_name": F.lit(table_name),
                "field_name": F.lit(f),
                "total_rows": F.col("total"),
                "null_count": F.col(f"null_{f}"),
                "pass_rate": classify.pass_percent(F.col(f"null_{f}"), F.col("total")),
            }
            for f in fields
        ],
    )


def uniqueness_metric(df: DataFrame, table_name: str, key: str) -> DataFrame:
    """Rows, rows of duplicated keys and pass percentage."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    totals = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias("duplicate_rows"),
    )
    return totals.select(
        F.lit(table_name).alias("table_name"),
        F.lit(key).alias("field_name"),
        "total_rows",
        "duplicate_rows",
        classify.pass_percent(F.col("duplicate_rows"), F.col("total_rows")).alias("pass_rate"),
    )


def rule_metrics(
    df: DataFrame, table_name: str, rule_list: Sequence[Rule], as_of: date
) -> DataFrame:
    """Evaluated (non-NULL) and invalid rows of each rule, with the pass percentage among them."""
    counts = []
    for i, rule in enumerate(rule_list):
        counts.append(F.count(F.col(rule.field)).alias(f"evaluated_{i}"))
        broken = rules.breaks(rule.field, rule.valid(as_of))
        counts.append(F.count_if(broken).alias(f"invalid_{i}"))
    return rows_of(
        df.agg(*counts),
        [
            {
                "table_name": F.lit(table_name),
                "field_name": F.lit(rule.field),
                "rule_name": F.lit(rule.label),
                "evaluated_rows": F.col(f"evaluated_{i}"),
                "invalid_rows": F.col(f"invalid_{i}"),
                "pass_rate": classify.pass_percent(F.col(f"invalid_{i}"), F.col(f"evaluated_{i}")),
            }
            for i, rule in enumerate(rule_list)
        ],
    )


def orphan_counts(df: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """One row: total rows, orphan rows and distinct orphan keys of a foreign key.

    Rows are counted per key first, so a hot key crosses the shuffle as one row per map task.
    """
    orphan = F.col(fk.column).isNotNull() & ~F.col("known")
    return key_presence(df, fk.column, parent, fk.parent_key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )


def referential_metrics(
    df: DataFrame, foreign_keys: Sequence[ForeignKey], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """All rows, orphan rows and pass percentage of each foreign key, from one scan of the child."""
    lookups = [Lookup(fk.column, parents[fk.parent], fk.parent_key) for fk in foreign_keys]
    counted = _key_totals(df, lookups)
    return rows_of(
        counted,
        [
            {
                "check_name": F.lit(f"{fk.column} referential"),
                "total_rows": F.col(f"total_{i}"),
                "orphan_rows": F.col(f"orphan_{i}"),
                "pass_rate": classify.pass_percent(F.col(f"orphan_{i}"), F.col(f"total_{i}")),
            }
            for i, fk in enumerate(foreign_keys)
        ],
    )


def _key_totals(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """One row: total, duplicate and orphan rows of each looked-up column, by its position."""
    rows = F.col("rows")

    def summed(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).alias(name)

    measures = []
    for i in range(len(lookups)):
        own = F.col("_set") == i
        measures += [
            summed(own, f"total_{i}"),
            summed(own & (rows > 1), f"duplicate_{i}"),
            summed(own & F.col("_filled") & ~F.col("known"), f"orphan_{i}"),
        ]
    return key_counts(df, lookups).agg(*measures)


def _report_row(passed: str, labels: Mapping[str, Column]) -> dict[str, Column]:
    return {
        **labels,
        "total_rows": F.col("total"),
        "passed": F.col(passed),
        "failed": F.col("total") - F.col(passed),
        "pass_rate": classify.pass_rate(F.col(passed), F.col("total")),
    }


def check_report(df: DataFrame, table_name: str) -> DataFrame:
    """Total, passed, failed and pass rate of each check and of the verdict, in one aggregate."""
    columns = {name: c for name, c in fixed.CHECK_COLUMNS.items() if c in df.columns}
    if fixed.VERDICT_COLUMN in df.columns:
        columns[fixed.OVERALL] = fixed.VERDICT_COLUMN
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c) == fixed.PASS).alias(f"passed_{n}") for n, c in columns.items()],
    )
    return rows_of(
        totals,
        [
            _report_row(f"passed_{n}", {"table_name": F.lit(table_name), "check_type": F.lit(n)})
            for n in columns
        ],
    )


def quality_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The report over all flagged tables."""
    return union_all([check_report(df, name) for name, df in frames.items()])


def _extended_measures(spec: TableSpec) -> list[tuple[str, str | None, Column]]:
    """Check, column, and what passes it, in the order of the report."""
    measures: list[tuple[str, str | None, Column]] = [
        ("completeness", f, F.col(f).isNotNull()) for f in spec.completeness
    ]
    measures.append(("completeness", "all_required", checks.all_filled(spec.required)))
    measures.append(("uniqueness", spec.primary_key, ~F.col(checks.DUPLICATE_MARKER)))
    measures.append(("type_validation", "all", F.col(checks.TYPE_VALIDATION) == fixed.PASS))
    measures += [
        ("referential_integrity", fk.column, ~F.col(checks.orphan_marker(fk.column)))
        for fk in spec.foreign_keys
    ]
    measures.append(("overall_pass", None, F.col(fixed.VERDICT_COLUMN) == fixed.PASS))
    return measures


def extended_counts(spec: TableSpec) -> list[Column]:
    """The aggregates of :func:`extended_report`, over a flagged frame that still holds its markers.

    They can also be observed while the frame is written.
    """
    measures = _extended_measures(spec)
    return [
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(passed).alias(f"passed_{i}") for i, (_, _, passed) in enumerate(measures)],
    ]


def extended_rows(totals: DataFrame, spec: TableSpec, run_id: str, run_timestamp: Column) -> DataFrame:
    """The report rows from the one row of :func:`extended_counts`."""
    return rows_of(
        totals,
        [
            _report_row(
                f"passed_{i}",
                {
                    "run_id": F.lit(run_id),
                    "run_timestamp": run_timestamp,
                    "table_name": F.lit(spec.silver),
                    "check_name": F.lit(check),
                    "column_name": F.lit(column).cast("string"),
                },
            )
            for i, (check, column, _) in enumerate(_extended_measures(spec))
        ],
    )


def extended_report(
    marked: DataFrame, spec: TableSpec, run_id: str, run_timestamp: Column
) -> DataFrame:
    """Report rows per column and per check of one table, stamped with the run.

    ``marked`` is a flagged frame that still holds its duplicate and orphan markers.
    """
    return extended_rows(marked.agg(*extended_counts(spec)), spec, run_id, run_timestamp)


def with_alerts(report: DataFrame) -> DataFrame:
    """Alert level of each report row and whether it misses the limit of its check.

    Both judge the exact share of passed rows, as the rounded rate may reach a limit that the rows miss.
    """
    exact = F.try_divide(F.col("passed").cast("double"), F.col("total_rows").cast("double"))
    rate = F.coalesce(exact, F.lit(1.0))
    limit = classify.check_limit(F.col("check_type"))
    return report.withColumns(
        {
            "alert_level": classify.alert_level(rate),
            "below_check_limit": F.coalesce(rate < limit, F.lit(False)),
        }
    )


def failures_by_reason(df: DataFrame) -> DataFrame:
    return df.groupBy(fixed.VERDICT_COLUMN).agg(F.count(F.lit(1)).alias("row_count"))


def pass_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """PASS and total rows of each table."""
    return union_all(
        [
            df.agg(
                F.count_if(F.col(fixed.VERDICT_COLUMN) == fixed.PASS).alias("pass_rows"),
                F.count(F.lit(1)).alias("total_rows"),
            ).select(F.lit(name).alias("table_name"), "pass_rows", "total_rows")
            for name, df in frames.items()
        ]
    )


def overall_pass_rate(frames: Mapping[str, DataFrame]) -> DataFrame:
    totals = pass_summary(frames).agg(
        F.sum("total_rows").alias("total_rows"), F.sum("pass_rows").alias("pass_rows")
    )
    share = F.try_divide(F.col("pass_rows").cast("double"), F.col("total_rows").cast("double"))
    return totals.withColumn("pass_rate_pct", F.coalesce(share * 100.0, F.lit(100.0)))


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Row count of every table of every layer."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
            )
            for layer, tables in layers.items()
            for name, df in tables.items()
        ]
    )


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def key_null_check(df: DataFrame, table_name: str, key_columns: Sequence[str]) -> DataFrame:
    """Rows, and rows with a NULL in any key column."""
    any_null = reduce(or_, [F.col(c).isNull() for c in key_columns])
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(any_null).alias("null_key_rows")
    ).select(F.lit(table_name).alias("table_name"), "row_count", "null_key_rows")


def silver_validation(
    bronze: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    expected_failures: DataFrame,
) -> DataFrame:
    """Per table: rows kept, verdicts present, and failures as expected.

    ``expected_failures`` holds ``table_name`` and ``expected_failed``, one row per table.
    """
    found = union_all(
        [
            df.agg(
                F.count(F.lit(1)).alias("silver_rows"),
                F.count_if(F.col(fixed.VERDICT_COLUMN).isNull()).alias("null_verdicts"),
                F.count_if(F.col(fixed.VERDICT_COLUMN) != fixed.PASS).alias("failed_rows"),
            ).select(F.lit(name).alias("table_name"), "silver_rows", "null_verdicts", "failed_rows")
            for name, df in silver.items()
        ]
    )
    landed = union_all(
        [
            df.agg(F.count(F.lit(1)).alias("bronze_rows")).select(
                F.lit(name).alias("table_name"), "bronze_rows"
            )
            for name, df in bronze.items()
        ]
    )
    return (
        found.join(landed, "table_name")
        .join(expected_failures, "table_name", "left")
        .withColumn(
            "is_valid",
            (F.col("silver_rows") >= F.col("bronze_rows"))
            & (F.col("null_verdicts") == 0)
            & F.coalesce(F.col("failed_rows") == F.col("expected_failed"), F.lit(True)),
        )
    )


def defect_inventory(
    bronze: Mapping[str, DataFrame], specs: Sequence[TableSpec]
) -> DataFrame:
    """Defects of the raw inputs before any check: totals, NULLs, duplicates and orphans.

    NULLs are counted as landed, keys in their declared types, as Silver compares them. Each table is
    scanned twice: for its NULLs, and for all its keys together.
    """
    parts = []
    typed = keys.typed_tables(bronze, specs)

    def part(spec: TableSpec, counted: DataFrame, labels: Mapping[str, str]) -> None:
        parts.append(
            rows_of(
                counted,
                [
                    {
                        "table_name": F.lit(spec.bronze),
                        "defect": F.lit(label),
                        "row_count": F.col(column),
                    }
                    for label, column in labels.items()
                ],
            )
        )

    for spec in specs:
        df = bronze[spec.name]
        totals = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in spec.completeness],
        )
        nulls = {f"NULL {f}": f"null_{f}" for f in spec.completeness}
        part(spec, totals, {"total rows": "total", **nulls})
        lookups = [
            Lookup(spec.primary_key),
            *[Lookup(fk.column, typed[fk.parent], fk.parent_key) for fk in spec.foreign_keys],
        ]
        orphans = {f"ORPHAN {fk.column}": f"orphan_{i}" for i, fk in enumerate(spec.foreign_keys, 1)}
        counted = _key_totals(typed[spec.name], lookups)
        part(spec, counted, {f"DUPLICATE {spec.primary_key}": "duplicate_0", **orphans})
    return union_all(parts)
