"""The layer runs: land extracts, flag them, aggregate the passing rows."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.operators import metrics
from assayline.plans import gold
from assayline.plans.silver import SPECS, marked_tables, without_markers
from assayline.sources.files import add_audit_columns, read_csv, resolve_source_path
from assayline.sources.tables import (
    append_table,
    drop_table,
    new_version,
    overwrite_table,
    publish_tables,
    stage_table,
    staging_name,
)
from assayline.specs import TABLES, TableSpec

log = logging.getLogger(__name__)

QUALITY_REPORT = "silver_quality_report"
QUALITY_METRICS = "silver_quality_metrics"


@dataclass(frozen=True)
class JobOutcome:
    """What became of one table."""

    table_name: str
    success: bool
    row_count: int = 0
    elapsed_seconds: float = 0.0
    error_kind: str | None = None
    error_message: str | None = None


def error_kind(error: Exception) -> str:
    """``missing_source``, ``missing_table``, ``schema`` or ``other``, by Spark's error condition."""
    condition = (error.getCondition() if isinstance(error, PySparkException) else None) or ""
    if condition.startswith("PATH_NOT_FOUND"):
        return "missing_source"
    if condition.startswith("TABLE_OR_VIEW_NOT_FOUND"):
        return "missing_table"
    if "SCHEMA" in condition or "UNRESOLVED_COLUMN" in condition or "INCOMPATIBLE" in condition:
        return "schema"
    return "other"


def _attempt(table_name: str, work: Callable[[], int]) -> JobOutcome:
    start = time.perf_counter()
    try:
        rows = work()
    except Exception as error:  # one table's failure must not stop the others
        elapsed = time.perf_counter() - start
        log.exception("%s failed", table_name)
        return JobOutcome(table_name, False, 0, elapsed, error_kind(error), str(error))
    elapsed = time.perf_counter() - start
    log.info("%s: %d rows in %.2fs", table_name, rows, elapsed)
    return JobOutcome(table_name, True, rows, elapsed)


# ---- Bronze ------------------------------------------------------------------------------------


def ingest(
    spark: SparkSession,
    spec: TableSpec,
    data_dir: str | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
    fmt: str = "parquet",
    run_timestamp: datetime | None = None,
) -> JobOutcome:
    """Land one extract as it came, with audit columns; failures are reported, not raised."""

    def work() -> int:
        path = resolve_source_path(spec.source_file, data_dir)
        stamp = F.current_timestamp() if run_timestamp is None else F.lit(run_timestamp)
        landed = add_audit_columns(read_csv(spark, path, infer=infer, encoding=encoding), path, stamp)
        written = overwrite_table(landed, spec.bronze, fmt)
        stored = spark.table(spec.bronze).count()
        if written != stored:
            log.warning("%s: %d rows written, %d rows stored", spec.bronze, written, stored)
        return stored

    return _attempt(spec.bronze, work)


def run_bronze(
    spark: SparkSession, data_dir: str | None = None, specs: Sequence[TableSpec] = TABLES, **options
) -> list[JobOutcome]:
    """Land all extracts, parents first; continue after a failure."""
    return [ingest(spark, spec, data_dir, **options) for spec in specs]


# ---- Silver ------------------------------------------------------------------------------------


def run_silver(
    spark: SparkSession,
    as_of: date | None = None,
    specs: Sequence[TableSpec] = TABLES,
    fmt: str = "parquet",
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Flag and write every table, then the report from the written tables; raise on failure.

    Each table is scanned twice: its key columns for the key sets, and its rows once, which are
    flagged, counted as they are read, measured per column if there is a ``run_id``, counted again
    as they are written, and staged. Only when every table holds as many rows as landed do all of
    them take the place of the former ones, in one version.
    """
    day, version = as_of or date.today(), new_version()
    bronze = {spec.name: spark.table(spec.bronze) for spec in specs}
    landed = {spec.name: Observation() for spec in specs}
    rows = {n: df.observe(landed[n], F.count(F.lit(1)).alias("rows")) for n, df in bronze.items()}
    marked = marked_tables(bronze, day, specs, rows=rows)
    counts = {spec.name: Observation() for spec in specs}
    if run_id is not None:
        for spec in specs:
            marked[spec.name] = marked[spec.name].observe(counts[spec.name], *metrics.extended_counts(spec))
    stored = {}
    try:
        for name, df in without_markers(marked, bronze).items():
            silver = SPECS[name].silver
            kept = stage_table(df, silver, fmt, version=version)
            read = int(landed[name].get["rows"])
            if read != kept:
                # A stage that ran again after a lost executor may have observed rows twice.
                read, kept = bronze[name].count(), spark.table(staging_name(silver)).count()
            if read != kept:
                raise ValueError(f"{silver} would hold {kept} rows, {SPECS[name].bronze} holds {read}")
            stored[name] = kept
        publish_tables(spark, [spec.silver for spec in specs])
    finally:
        for spec in specs:
            drop_table(spark, staging_name(spec.silver))
    silver = {spec.silver: spark.table(spec.silver) for spec in specs}

    overwrite_table(metrics.quality_report(silver), QUALITY_REPORT, fmt)
    report = spark.table(QUALITY_REPORT)
    if run_id is not None:
        parts = []
        for spec in specs:
            found = {n: int(v) for n, v in counts[spec.name].get.items()}
            if found["total"] == stored[spec.name]:
                totals = spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in found.items()])
            else:  # observed twice, as above
                again = marked_tables(bronze, day, [spec])[spec.name]
                totals = again.agg(*metrics.extended_counts(spec))
            parts.append(metrics.extended_rows(totals, spec, run_id, F.current_timestamp()))
        append_table(metrics.union_all(parts), QUALITY_METRICS, fmt)
    return {**silver, QUALITY_REPORT: report}


def blocked_tables(report: DataFrame) -> DataFrame:
    """The rows of the report that say how many verdicts pass, of tables at the critical alert level."""
    verdicts = metrics.with_alerts(report.filter(F.col("check_type") == fixed.OVERALL))
    return verdicts.filter(F.col("alert_level") == "critical")


def promotion_gate(report: DataFrame) -> None:
    """Raise when the verdicts of any table are at the critical alert level."""
    blocked = [row["table_name"] for row in blocked_tables(report).collect()]  # at most a row per table
    if blocked:
        raise ValueError(f"pass rate below {fixed.WARNING_FROM:.1%}: {', '.join(sorted(blocked))}")


# ---- Gold --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class GoldJob:
    table_name: str
    key_columns: tuple[str, ...]
    build: Callable[[SparkSession, date], DataFrame]


GOLD_JOBS = (
    GoldJob(
        "gold_sales_by_product",
        ("product_id", "product_name", "category", "total_revenue"),
        lambda spark, _: gold.sales_by_product(
            spark.table("silver_orders"), spark.table("silver_products")
        ),
    ),
    GoldJob(
        "gold_revenue_by_customer",
        ("customer_id", "customer_name", "total_revenue"),
        lambda spark, as_of: gold.revenue_by_customer(
            spark.table("silver_orders"), spark.table("silver_customers"), as_of
        ),
    ),
    GoldJob(
        "gold_customer_segmentation",
        ("segment_type", "customer_count", "total_revenue"),
        lambda spark, _: gold.customer_segmentation(spark.table("gold_revenue_by_customer")),
    ),
)


def validate_table(
    df: DataFrame, table_name: str, key_columns: Sequence[str], allow_empty: bool = False
) -> int:
    """Rows of a table that has its key columns, none of them NULL; raise otherwise."""
    absent = metrics.missing_columns(df, key_columns)
    if absent:
        raise ValueError(f"{table_name} lacks the columns {absent}")
    found = metrics.key_null_check(df, table_name, key_columns).first()
    if found["row_count"] == 0 and not allow_empty:
        raise ValueError(f"{table_name} has no rows")
    if found["null_key_rows"] > 0:
        raise ValueError(f"{table_name} has {found['null_key_rows']} rows with a NULL key column")
    return found["row_count"]


def run_gold(
    spark: SparkSession,
    as_of: date | None = None,
    jobs: Sequence[GoldJob] = GOLD_JOBS,
    fmt: str = "parquet",
    allow_empty: bool = False,
    gate: bool = False,
) -> dict[str, JobOutcome]:
    """Build, validate and write the Gold tables in order; continue after a failure.

    The aggregate is staged as a table, validated there, and then replaces the former table, so
    Silver is read and each result written once.
    """
    day = as_of or date.today()
    if gate:
        promotion_gate(spark.table(QUALITY_REPORT))

    def work(job: GoldJob) -> int:
        staged = staging_name(job.table_name)
        try:
            stage_table(job.build(spark, day), job.table_name, fmt)
            rows = validate_table(spark.table(staged), job.table_name, job.key_columns, allow_empty)
            publish_tables(spark, [job.table_name])
            return rows
        finally:
            drop_table(spark, staged)

    return {job.table_name: _attempt(job.table_name, lambda job=job: work(job)) for job in jobs}
