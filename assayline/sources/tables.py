"""Catalog tables: definitions, reading, overwriting, dropping."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.fixed_values import DATABASE, VERDICT_COLUMN
from assayline.sources.files import folder_names, remove_folder
from assayline.specs import MONEY, TABLES, TableSpec


@dataclass(frozen=True)
class TableDefinition:
    name: str
    schema: T.StructType
    comment: str


def _schema(*columns: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in columns])


AUDIT = _schema(
    ("ingestion_timestamp", T.TimestampType(), "When the row was landed"),
    ("source_file", T.StringType(), "Where the row came from"),
)
VERDICT = _schema((VERDICT_COLUMN, T.StringType(), "PASS, or FAIL and the failed checks"))

QUALITY_REPORT = _schema(
    ("table_name", T.StringType(), "Table checked"),
    ("check_type", T.StringType(), "Check, or overall"),
    ("total_rows", T.LongType(), "Rows checked"),
    ("passed", T.LongType(), "Rows that pass"),
    ("failed", T.LongType(), "Rows that fail"),
    ("pass_rate", T.DoubleType(), "Passed share of all rows, 0 to 1"),
)
SALES_BY_PRODUCT = _schema(
    ("product_id", T.LongType(), "Product"),
    ("product_name", T.StringType(), "Display name"),
    ("category", T.StringType(), "Catalogue category"),
    ("total_orders", T.LongType(), "Distinct orders"),
    ("total_quantity", T.LongType(), "Units sold"),
    ("total_revenue", MONEY, "Sum of order amounts"),
    ("avg_order_value", T.DoubleType(), "Mean order amount"),
    ("profit_margin", T.DoubleType(), "Catalogue margin in percent"),
)
REVENUE_BY_CUSTOMER = _schema(
    ("customer_id", T.LongType(), "Customer"),
    ("customer_name", T.StringType(), "Full name"),
    ("customer_segment", T.StringType(), "Segment given by the source"),
    ("country", T.StringType(), "Country"),
    ("total_orders", T.LongType(), "Distinct orders"),
    ("total_revenue", MONEY, "Sum of order amounts"),
    ("avg_order_value", T.DoubleType(), "Mean order amount"),
    ("first_order_date", T.DateType(), "First order"),
    ("last_order_date", T.DateType(), "Last order"),
    ("lifetime_value_actual", MONEY, "Lifetime value computed from orders"),
    ("days_since_last_order", T.IntegerType(), "Days from the last order to the evaluation day"),
)
CUSTOMER_SEGMENTATION = _schema(
    ("segment_type", T.StringType(), "Behavioural segment"),
    ("customer_count", T.LongType(), "Customers in the segment"),
    ("avg_revenue", T.DoubleType(), "Mean revenue per customer"),
    ("total_revenue", MONEY, "Revenue of the segment"),
    ("avg_orders", T.DoubleType(), "Mean orders per customer"),
    ("pct_of_total_customers", T.DoubleType(), "Share of all customers in percent"),
)


def _merge(*schemas: T.StructType) -> T.StructType:
    return T.StructType([field for schema in schemas for field in schema])


def _layer_tables(spec: TableSpec) -> list[TableDefinition]:
    return [
        TableDefinition(spec.bronze, _merge(spec.schema, AUDIT), f"{spec.name} as landed"),
        TableDefinition(
            spec.silver, _merge(spec.schema, AUDIT, VERDICT), f"All {spec.name} rows with a verdict"
        ),
    ]


DEFINITIONS = {
    d.name: d
    for d in [
        *[d for spec in TABLES for d in _layer_tables(spec)],
        TableDefinition("silver_quality_report", QUALITY_REPORT, "Pass rates per table and check"),
        TableDefinition("gold_sales_by_product", SALES_BY_PRODUCT, "Sales of each product"),
        TableDefinition("gold_revenue_by_customer", REVENUE_BY_CUSTOMER, "Revenue of each customer"),
        TableDefinition("gold_customer_segmentation", CUSTOMER_SEGMENTATION, "Customer segments"),
    ]
}


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_statement(definition: TableDefinition, fmt: str = "parquet") -> str:
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()} COMMENT {_quoted(f.metadata['comment'])}"
        for f in definition.schema
    )
    return (
        f"CREATE TABLE IF NOT EXISTS {definition.name} ({columns}) "
        f"USING {fmt} COMMENT {_quoted(definition.comment)}"
    )


def create_tables(spark: SparkSession, database: str | None = DATABASE, fmt: str = "parquet") -> None:
    """Create the database and all empty tables; existing ones stay as they are."""
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        spark.catalog.setCurrentDatabase(database)
    for definition in DEFINITIONS.values():
        spark.sql(create_statement(definition, fmt))


def _with_comments(df: DataFrame, name: str) -> DataFrame:
    definition = DEFINITIONS.get(name)
    if definition is None:
        return df
    comments = {f.name: f.metadata for f in definition.schema}
    return df.select(
        *[F.col(c).alias(c, metadata=comments[c]) if c in comments else F.col(c) for c in df.columns]
    )


# ---- content in versions -----------------------------------------------------------------------
#
# Each content of a table lies in a folder of its own, ``<database>/<table>__versions/<version>``. New
# content is written beside the current one and takes its place by a change of the table's location,
# one operation of the catalog: readers find the former or the new content, and never none.

VERSIONS = "__versions"
VERSIONS_KEPT = 2  # the current one, and the one that readers may still be reading


def new_version() -> str:
    """A name for what one run writes; names sort by time."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _versions_folder(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{table}{VERSIONS}"


def table_location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return described["data_type"] if described else None


def staging_name(name: str) -> str:
    """Where the next content of a table can be read until it has passed its checks."""
    return f"{name}__staged"


def stage_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    version: str | None = None,
) -> int:
    """Write the next content of the table and return its rows; the table itself stays as it is.

    The count is observed on the rows as they are written; the plan runs once.
    """
    spark, staged = df.sparkSession, staging_name(name)
    drop_table(spark, staged)
    written = Observation()
    observed = _with_comments(df, name).observe(written, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", f"{_versions_folder(spark, name)}/{version or new_version()}").saveAsTable(staged)
    if name in DEFINITIONS:
        spark.sql(f"COMMENT ON TABLE {staged} IS {_quoted(DEFINITIONS[name].comment)}")
    return int(written.get["rows"])


def _columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return spark.table(name).dtypes


def _partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def publish_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Put the staged contents in the place of the tables; rows are neither read nor written again.

    A table that keeps its columns changes its location only. Where columns change, or the table is
    partitioned, it is dropped and the staged one renamed. If one table fails, those before it go
    back to their former content.
    """
    moved: list[tuple[str, str]] = []
    try:
        for name in names:
            staged, former = staging_name(name), table_location(spark, name)
            same = former is not None and _columns(spark, name) == _columns(spark, staged)
            if same and not _partitioned(spark, staged):
                spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(table_location(spark, staged))}")
                moved.append((name, former))
                spark.sql(f"DROP TABLE {staged}")
            else:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        for name, former in reversed(moved):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(former)}")
        raise
    for name in names:
        _remove_old_versions(spark, name)


def _remove_old_versions(spark: SparkSession, name: str) -> None:
    folder, current = _versions_folder(spark, name), table_location(spark, name)
    older = sorted(v for v in folder_names(spark, folder) if not current.endswith(f"/{v}"))
    for version in older[: max(0, len(older) - VERSIONS_KEPT + 1)]:
        remove_folder(spark, f"{folder}/{version}")


def snapshot(spark: SparkSession, names: Sequence[str], fmt: str = "parquet", tries: int = 20) -> dict[str, DataFrame]:
    """Tables that one run published together, all of one version and pinned to its folders.

    Between two location changes of one run the tables are of two versions for a moment; then they
    are asked for again.
    """
    for _ in range(tries):
        found = {name: table_location(spark, name) for name in names}
        if None not in found.values() and len({place.rsplit("/", 1)[-1] for place in found.values()}) == 1:
            return {n: spark.read.format(fmt).schema(spark.table(n).schema).load(place) for n, place in found.items()}
        time.sleep(0.1)
    raise ValueError(f"tables of different versions: {found}")


def overwrite_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> int:
    """Replace the table, its columns included, and return the rows written."""
    rows = stage_table(df, name, fmt, partition_by)
    publish_tables(df.sparkSession, [name])
    return rows


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Add the rows to the table, created on first use."""
    df.write.format(fmt).mode("append").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table with its content; a table also with its former versions."""
    location = table_location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder, _, _ = (location or "").rpartition("/")
    if folder.endswith(VERSIONS):
        own = folder.rsplit("/", 1)[-1] == f"{name.rpartition('.')[2]}{VERSIONS}"
        remove_folder(spark, folder if own else location)


def sample_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
