"""The registered queries: every operator over whole tables derived from the given star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.operators import checks, metrics
from assayline.operators.lookup import shared_folder
from assayline.plans import dashboard, dimensions, gold, jobs, reconcile
from assayline.plans.dashboard import DashboardFilters
from assayline.plans.silver import flagged_tables, marked_tables
from assayline.samples import star
from assayline.samples.defects import Defect, defect_summary, inject_defects
from assayline.sources.files import (
    add_audit_columns,
    add_batch_row_count,
    read_csv,
    remove_folder,
    write_csv,
)
from assayline.sources.tables import snapshot
from assayline.specs import CUSTOMERS, ORDERS, PRODUCTS, TABLES

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = star.AS_OF
RUN_ID = "run-2001-08-02"
RUN_TIMESTAMP = datetime(2001, 8, 2, 6, 0, 0)
GARBLED = Defect("garbled name", "customer_name", "customer_id % 50 = 9", "'JosÃ© ' || customer_name")

# What a text extract may hold in place of a value: other ways to write it, and what is none.
CUSTOMER_TEXTS = (
    Defect("decimal key", "customer_id", "c % 70 = 3", "concat(customer_id, '.0')"),
    Defect("padded key", "customer_id", "c % 110 = 5", "concat(' ', customer_id)"),
    Defect("month", "signup_date", "c % 130 = 9", "'1994-05'"),
)
PRODUCT_TEXTS = (
    Defect("padded key", "product_id", "p % 90 = 4", "concat(' ', product_id)"),
    Defect("decimal key", "product_id", "p % 120 = 6", "concat(product_id, '.0')"),
    Defect("three digits", "price", "p % 150 = 9", "'12.345'"),
    Defect("no number", "cost", "p % 210 = 19", "'NaN'"),
    Defect("out of range", "stock_quantity", "p % 170 = 13", "'1e20'"),
    Defect("decimal integer", "stock_quantity", "p % 190 = 17", "'7.0'"),
    Defect("word", "reorder_level", "p % 230 = 23", "'abc'"),
)
ORDER_TEXTS = (
    Defect("decimal key", "order_id", "o % 900 = 7", "concat(order_id, '.0')"),
    Defect("padded key", "order_id", "o % 1500 = 4", "concat(' ', order_id)"),
    Defect("word for a key", "order_id", "o % 700 = 17", "'abc'"),
    Defect("decimal foreign key", "customer_id", "o % 80 = 19", "concat(customer_id, '.0')"),
    Defect("word for a foreign key", "customer_id", "o % 760 = 23", "'x'"),
    Defect("padded foreign key", "product_id", "o % 95 = 11", "concat(' ', product_id)"),
    Defect("year", "order_date", "o % 600 = 47", "'2000'"),
    Defect("month", "order_date", "o % 610 = 53", "'2000-05'"),
    Defect("day and more", "order_date", "o % 620 = 59", "'2000-02-03 junk'"),
    Defect("time of day", "payment_date", "o % 630 = 61", "'2000-02-03T99'"),
    Defect("out of range", "quantity", "o % 640 = 29", "'1e20'"),
    Defect("decimal integer", "quantity", "o % 650 = 31", "'3.0'"),
    Defect("fraction", "quantity", "o % 660 = 37", "'2.5'"),
    Defect("word", "unit_price", "o % 670 = 67", "'abc'"),
    Defect("three digits", "total_amount", "o % 680 = 41", "'12.345'"),
    Defect("no number", "total_amount", "o % 690 = 43", "'NaN'"),
)

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _bronze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return star.source_tables(spark, folder)


def _silver(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Flagged tables by name; all three unless some are named."""
    wanted = [spec for spec in TABLES if not names or spec.name in names]
    needed = {spec.name for spec in wanted}
    needed |= {fk.parent for spec in wanted for fk in spec.foreign_keys}
    bronze = {name: star.BUILDERS[name](spark, folder) for name in needed}
    return flagged_tables(bronze, AS_OF, wanted)


def _text_bronze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three sources as an extract lands them, every column text, with odd texts among them."""
    texts = {"customers": ("c", CUSTOMER_TEXTS), "products": ("p", PRODUCT_TEXTS), "orders": ("o", ORDER_TEXTS)}
    landed = {}
    for spec in TABLES:
        number, odd = texts[spec.name]
        df = star.BUILDERS[spec.name](spark, folder)
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.col(spec.primary_key).alias(number))
        landed[spec.name] = inject_defects(text, odd).drop(number)
    return landed


def _silver_named(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {f"silver_{name}": df for name, df in _silver(spark, folder).items()}


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder, "orders", "products")
    return gold.sales_by_product(silver["orders"], silver["products"])


def _revenue(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder, "orders", "customers")
    return gold.revenue_by_customer(silver["orders"], silver["customers"], AS_OF)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, "orders")["orders"]


def _tiers(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder, "orders", "customers")
    return gold.value_tiers(silver["orders"], silver["customers"])


# ---- landing -----------------------------------------------------------------------------------


@query
def csv_roundtrip_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All orders written as CSV to the shared folder and read back by header name."""
    path = f"{shared_folder(spark).rstrip('/')}/csv-{uuid.uuid4().hex}/orders.csv"
    write_csv(star.orders(spark, folder), path)
    return read_csv(spark, path, schema=ORDERS.schema)


@query
def bronze_audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    return add_audit_columns(
        star.customers(spark, folder), "landing/customers.csv", F.lit(RUN_TIMESTAMP)
    )


@query
def bronze_batch_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return add_batch_row_count(star.products(spark, folder)).select("product_id", "row_count")


@query
def raw_defect_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.defect_inventory(_bronze(spark, folder), TABLES)


@query
def injected_defect_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.union_all(
        [
            defect_summary(star.clean_customers(spark, folder), "customers", star.CUSTOMER_DEFECTS),
            defect_summary(star.clean_products(spark, folder), "products", star.PRODUCT_DEFECTS),
            defect_summary(star.clean_orders(spark, folder), "orders", star.ORDER_DEFECTS),
        ]
    )


@query
def probe_mojibake(spark: SparkSession, folder: str) -> DataFrame:
    garbled = inject_defects(star.customers(spark, folder), [GARBLED])
    return reconcile.mojibake_rows(garbled, "customer_name").select("customer_id", "customer_name")


@query
def probe_column_types(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.column_types(star.products(spark, folder), ["product_id", "price", "cost"])


def _kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows in a checkpoint of their own, so that what they were read from can be removed."""
    shared_folder(spark)
    return df.checkpoint()


@contextmanager
def _landing(spark: SparkSession) -> Iterator[str]:
    """A folder for extracts in the shared folder, removed afterwards."""
    path = f"{shared_folder(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove_folder(spark, path)


@query
def landing_by_header(spark: SparkSession, folder: str) -> DataFrame:
    """All products landed from files whose columns are in another order and have one more."""
    with _landing(spark) as path:
        products = star.products(spark, folder)
        shuffled = products.select(*reversed(products.columns), F.upper("product_name").alias("remark"))
        write_csv(shuffled, path)
        return _kept(spark, read_csv(spark, path, schema=PRODUCTS.schema))


@query
def landing_of_headers_alone(spark: SparkSession, folder: str) -> DataFrame:
    """Extracts that hold only headers run through every layer; the report counts no row."""
    with _landing(spark) as path:
        landed = {}
        for name, df in _bronze(spark, folder).items():
            write_csv(df.filter("false").coalesce(1), f"{path}/{name}")
            landed[name] = read_csv(spark, f"{path}/{name}")
        silver = flagged_tables(landed, AS_OF)
        report = metrics.quality_report({f"silver_{n}": df for n, df in silver.items()})
        return _kept(spark, report.select("table_name", "check_type", "total_rows", "failed", "pass_rate"))


@query
def landing_in_latin1(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with accents in their names, from ISO-8859-1 files read as such; none is garbled."""
    with _landing(spark) as path:
        named = star.customers(spark, folder).withColumn("customer_name", F.concat(F.lit("José "), "customer_name"))
        write_csv(named, path, encoding="ISO-8859-1")
        landed = read_csv(spark, path, schema=CUSTOMERS.schema, encoding="ISO-8859-1")
        garbled = reconcile.mojibake_rows(landed, "customer_name")
        return _kept(spark, landed.select("customer_id", "customer_name").exceptAll(garbled.select("customer_id", "customer_name")))


# ---- stored layers -----------------------------------------------------------------------------


@contextmanager
def _stored_layers(spark: SparkSession, folder: str) -> Iterator[list[jobs.JobOutcome]]:
    """All three layers run from CSV extracts into a database of their own, dropped afterwards."""
    database, former = f"layers_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {database}")
    spark.catalog.setCurrentDatabase(database)
    try:
        with _landing(spark) as path:
            for spec in TABLES:
                write_csv(star.BUILDERS[spec.name](spark, folder), f"{path}/{spec.source_file}")
            landed = jobs.run_bronze(spark, path, run_timestamp=RUN_TIMESTAMP)
        jobs.run_silver(spark, AS_OF)
        jobs.run_gold(spark, AS_OF)
        yield landed
    finally:
        spark.catalog.setCurrentDatabase(former)
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def stored_layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows reported by the writes of Bronze, and rows read back from every stored table."""
    with _stored_layers(spark, folder) as landed:
        written = {o.table_name: o.row_count for o in landed}
        names = [*written, *[s.silver for s in TABLES], *[j.table_name for j in jobs.GOLD_JOBS]]
        counts = [
            spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(n).alias("table_name"), F.lit(written.get(n)).cast("long").alias("rows_written"), "row_count"
            )
            for n in names
        ]
        return _kept(spark, metrics.union_all(counts))


@query
def landing_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of each extract when one is absent: the others land all the same."""
    database, former = f"outcomes_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {database}")
    spark.catalog.setCurrentDatabase(database)
    try:
        with _landing(spark) as path:
            for spec in (CUSTOMERS, ORDERS):
                write_csv(star.BUILDERS[spec.name](spark, folder), f"{path}/{spec.source_file}")
            found = jobs.run_bronze(spark, path)
        rows = [(o.table_name, o.success, o.row_count, o.error_kind) for o in found]
        return spark.createDataFrame(rows, "table_name string, success boolean, row_count long, error_kind string")
    finally:
        spark.catalog.setCurrentDatabase(former)
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def stored_top_products(spark: SparkSession, folder: str) -> DataFrame:
    with _stored_layers(spark, folder):
        return _kept(spark, dashboard.top_products(spark.table("gold_sales_by_product")))


@query
def stored_revenue_histogram(spark: SparkSession, folder: str) -> DataFrame:
    with _stored_layers(spark, folder):
        return _kept(spark, dashboard.revenue_histogram(spark.table("gold_revenue_by_customer")))


@query
def stored_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    with _stored_layers(spark, folder):
        return _kept(spark, dashboard.segmentation_breakdown(spark.table("gold_customer_segmentation")))


@query
def stored_monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    """From one snapshot of the stored Silver tables."""
    with _stored_layers(spark, folder):
        silver = snapshot(spark, [s.silver for s in TABLES])
        return _kept(spark, dashboard.monthly_trend(silver["silver_orders"]))


# ---- completeness ------------------------------------------------------------------------------


@query
def dq_completeness_customers(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_completeness(star.customers(spark, folder), CUSTOMERS.completeness)
    return flagged.select("customer_id", "email", checks.COMPLETENESS)


@query
def dq_completeness_orders(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_completeness(star.orders(spark, folder), ORDERS.completeness)
    return flagged.select("order_id", "customer_id", "product_id", checks.COMPLETENESS)


@query
def dq_completeness_required(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    return metrics.union_all(
        [
            bronze[spec.name].select(
                F.lit(spec.silver).alias("table_name"),
                F.col(spec.primary_key).alias("row_key"),
                checks.all_filled(spec.required).alias("completeness_pass"),
            )
            for spec in TABLES
        ]
    )


@query
def dq_completeness_failed_columns(spark: SparkSession, folder: str) -> DataFrame:
    return star.orders(spark, folder).select(
        "order_id", checks.unfilled_fields(ORDERS.required).alias("completeness_failed_columns")
    )


@query
def dq_metric_completeness(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    return metrics.union_all(
        [
            metrics.completeness_metrics(bronze[spec.name], spec.bronze, spec.completeness)
            for spec in TABLES
            if spec.completeness
        ]
    )


# ---- uniqueness --------------------------------------------------------------------------------


@query
def dq_uniqueness_customers(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_uniqueness(star.customers(spark, folder), ["customer_id"])
    return flagged.select("customer_id", "customer_name", checks.UNIQUENESS)


@query
def dq_uniqueness_orders(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_uniqueness(star.orders(spark, folder), ["order_id"])
    return flagged.select("order_id", "total_amount", checks.UNIQUENESS)


@query
def dq_uniqueness_products(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_uniqueness(star.products(spark, folder), ["product_id"])
    return flagged.select("product_id", checks.UNIQUENESS)


@query
def dq_uniqueness_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """A composite key with many natural duplicates."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    keyed = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return checks.flag_uniqueness(keyed, ["l_orderkey", "l_linenumber"])


@query
def dq_uniqueness_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    landed = star.orders(spark, folder).select("order_id", "order_date", "customer_id", "total_amount")
    return checks.flag_keep_first(
        landed, ["order_id"], ["order_date", "customer_id", "total_amount"]
    )


@query
def dq_uniqueness_keep_first_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each (order, part), by line number: a composite key with natural duplicates."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_linenumber")
    return checks.flag_keep_first(lines, ["l_orderkey", "l_suppkey"], ["l_linenumber"])


def _repeated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Passing orders, each twice, without the flag that says that none repeats."""
    orders = _orders(spark, folder).drop(checks.UNIQUENESS)
    return orders.unionByName(orders)


@query
def gold_sales_distinct_orders(spark: SparkSession, folder: str) -> DataFrame:
    products = _silver(spark, folder, "products")["products"]
    sales = gold.sales_by_product(_repeated_orders(spark, folder), products)
    return sales.select("product_id", "total_orders")


@query
def monthly_orders_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.monthly_trend(_repeated_orders(spark, folder)).select("month", "monthly_orders")


@query
def dq_metric_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    return metrics.union_all(
        [
            metrics.uniqueness_metric(bronze[spec.name], spec.bronze, spec.primary_key)
            for spec in TABLES
        ]
    )


# ---- type and format ---------------------------------------------------------------------------


@query
def dq_type_customers(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_types(star.customers(spark, folder), CUSTOMERS.rules, AS_OF)
    return flagged.select("customer_id", "email", "signup_date", checks.TYPE_VALIDATION)


@query
def dq_type_orders(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_types(star.orders(spark, folder), ORDERS.rules, AS_OF)
    return flagged.select(
        "order_id", "quantity", "total_amount", "order_date", checks.TYPE_VALIDATION
    )


@query
def dq_type_products(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_types(star.products(spark, folder), PRODUCTS.rules, AS_OF)
    return flagged.select("product_id", "price", "cost", checks.TYPE_VALIDATION)


@query
def dq_type_extended(spark: SparkSession, folder: str) -> DataFrame:
    """The extended rules on values landed as text, some of them unreadable."""
    bronze = _bronze(spark, folder)
    unreadable = {
        "customers": ("customer_id", "lifetime_value", 40),
        "products": ("product_id", "stock_quantity", 60),
        "orders": ("order_id", "unit_price", 700),
    }
    parts = []
    for spec in TABLES:
        key, damaged, every = unreadable[spec.name]
        text = bronze[spec.name].select(
            [F.col(c).cast("string").alias(c) for c in bronze[spec.name].columns]
        )
        text = inject_defects(text, [Defect("text", damaged, f"{key} % {every} = 2", "'N/A'")])
        parts.append(
            checks.flag_types(text, spec.extended_rules, AS_OF).select(
                F.lit(spec.silver).alias("table_name"),
                F.col(spec.primary_key).cast("bigint").alias("row_key"),
                checks.TYPE_VALIDATION,
            )
        )
    return metrics.union_all(parts)


@query
def dq_metric_type_rules(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    return metrics.union_all(
        [
            metrics.rule_metrics(bronze[spec.name], spec.bronze, spec.rules, AS_OF)
            for spec in TABLES
        ]
    )


@query
def silver_standardize(spark: SparkSession, folder: str) -> DataFrame:
    """Padded text columns back to their declared types."""
    orders = star.orders(spark, folder)
    padded = orders.select(
        [F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in orders.columns]
    )
    return checks.standardize(padded, ORDERS.schema)


# ---- referential integrity ---------------------------------------------------------------------


def _orphans(spark: SparkSession, folder: str, column: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    fk = next(fk for fk in ORDERS.foreign_keys if fk.column == column)
    return metrics.orphan_counts(bronze["orders"], fk, bronze[fk.parent])


@query
def dq_orphans_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder, "customer_id")


@query
def dq_orphans_product(spark: SparkSession, folder: str) -> DataFrame:
    return _orphans(spark, folder, "product_id")


@query
def dq_metric_referential(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    return metrics.referential_metrics(bronze["orders"], ORDERS.foreign_keys, bronze)


@query
def dq_referential_orders(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    flagged = checks.flag_referential(bronze["orders"], ORDERS.foreign_keys, bronze)
    return flagged.select("order_id", "customer_id", "product_id", checks.REFERENTIAL)


@query
def dq_referential_detail(spark: SparkSession, folder: str) -> DataFrame:
    bronze = _bronze(spark, folder)
    marked = checks.flag_referential(
        bronze["orders"], ORDERS.foreign_keys, bronze, keep_markers=True
    )
    detail = checks.referential_detail(
        {"customer_id": "MISSING_CUSTOMER", "product_id": "MISSING_PRODUCT"}
    )
    return marked.select(
        "order_id", "customer_id", "product_id", detail.alias("referential_failure_detail")
    )


# ---- business rules and verdicts ---------------------------------------------------------------


@query
def dq_business_rules(spark: SparkSession, folder: str) -> DataFrame:
    flagged = checks.flag_business_rules(star.orders(spark, folder), AS_OF)
    return flagged.select("order_id", "quantity", "total_amount", fixed.BUSINESS_COLUMN)


@query
def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, "customers")["customers"]


@query
def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return _silver(spark, folder, "products")["products"]


@query
def silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder)


@query
def silver_pass_filter(spark: SparkSession, folder: str) -> DataFrame:
    return checks.passing(_orders(spark, folder)).select("order_id", "customer_id", "total_amount")


@query
def quarantine_orders(spark: SparkSession, folder: str) -> DataFrame:
    return checks.failing(_orders(spark, folder))


@query
def verdict_without_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that no check has flagged pass."""
    return checks.combine_flags(star.orders(spark, folder).select("order_id"))


@query
def rows_by_failure_reason(spark: SparkSession, folder: str) -> DataFrame:
    found = checks.failing_with(_orders(spark, folder), "ORPHAN customer_id")
    return found.select("order_id", "customer_id", fixed.VERDICT_COLUMN)


@query
def dq_composite_code(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return orders.select(
        "order_id",
        checks.composite_code(orders).alias("quality_code"),
        checks.failure_reasons(orders).alias("quality_failure_reasons"),
    )


@query
def dq_first_failure(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return orders.select("order_id", checks.first_failure_code(orders).alias("quality_code"))


@query
def silver_orders_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as text: what its declared type cannot keep fails by name, the rest is unchanged."""
    return flagged_tables(_text_bronze(spark, folder), AS_OF, [ORDERS])["orders"]


@query
def silver_products_from_text(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_tables(_text_bronze(spark, folder), AS_OF, [PRODUCTS])["products"]


@query
def silver_customers_from_text(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_tables(_text_bronze(spark, folder), AS_OF, [CUSTOMERS])["customers"]


@query
def gold_sales_from_text(spark: SparkSession, folder: str) -> DataFrame:
    silver = flagged_tables(_text_bronze(spark, folder), AS_OF, [PRODUCTS, ORDERS])
    return gold.sales_by_product(silver["orders"], silver["products"])


@query
def key_checks_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with duplicate and orphaned keys as Silver, the single dimensions and the inventory see them."""
    bronze = _text_bronze(spark, folder)
    found = ("key_check", "row_count")
    marked = marked_tables(bronze, AS_OF)
    parts = []
    for spec in TABLES:
        labels = {checks.DUPLICATE_MARKER: f"DUPLICATE {spec.primary_key}"}
        labels |= {checks.orphan_marker(fk.column): f"ORPHAN {fk.column}" for fk in spec.foreign_keys}
        counted = marked[spec.name].agg(*[F.count_if(F.col(m)).alias(m) for m in labels])
        rows = [{found[0]: F.lit(label), found[1]: F.col(m)} for m, label in labels.items()]
        parts.append(metrics.rows_of(counted, rows).select(F.lit("silver").alias("seen_by"), *found))
    unique = dimensions.uniqueness(bronze)[1]
    parts.append(
        unique.select(
            F.lit("dimensions").alias("seen_by"),
            F.concat(F.lit("DUPLICATE "), "field_name").alias(found[0]),
            F.col("duplicate_rows").alias(found[1]),
        )
    )
    orphans = dimensions.referential_integrity(bronze)[1]
    parts.append(
        orphans.select(
            F.lit("dimensions").alias("seen_by"),
            F.concat(F.lit("ORPHAN "), F.replace("check_name", F.lit(" referential"), F.lit(""))).alias(found[0]),
            F.col("orphan_rows").alias(found[1]),
        )
    )
    listed = metrics.defect_inventory(bronze, TABLES).filter("defect LIKE 'DUPLICATE %' OR defect LIKE 'ORPHAN %'")
    parts.append(listed.select(F.lit("inventory").alias("seen_by"), F.col("defect").alias(found[0]), found[1]))
    return metrics.union_all(parts)


# ---- reports -----------------------------------------------------------------------------------


@query
def silver_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.quality_report(_silver_named(spark, folder)).orderBy("table_name", "check_type")


@query
def quality_metrics_extended(spark: SparkSession, folder: str) -> DataFrame:
    marked = marked_tables(_bronze(spark, folder), AS_OF)
    return metrics.union_all(
        [
            metrics.extended_report(marked[spec.name], spec, RUN_ID, F.lit(RUN_TIMESTAMP))
            for spec in TABLES
        ]
    )


@query
def quality_alert_level(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.with_alerts(metrics.quality_report(_silver_named(spark, folder)))


@query
def promotion_blocked_tables(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.blocked_tables(metrics.quality_report(_silver_named(spark, folder)))


@query
def dimension_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What each quality dimension measures when it is run alone, over all tables."""
    bronze = _bronze(spark, folder)
    measured = {
        "completeness": (dimensions.completeness(bronze)[1], "field_name", "null_count"),
        "uniqueness": (dimensions.uniqueness(bronze)[1], "field_name", "duplicate_rows"),
        "type_validation": (dimensions.type_validation(bronze, AS_OF)[1], "rule_name", "invalid_rows"),
        "referential_integrity": (dimensions.referential_integrity(bronze)[1], "check_name", "orphan_rows"),
    }
    return metrics.union_all(
        [
            df.select(
                F.lit(name).alias("dimension"),
                (F.col("table_name") if "table_name" in df.columns else F.lit(ORDERS.bronze)).alias("table_name"),
                F.col(measure).alias("measure"),
                F.col(failed).alias("failed_rows"),
                "pass_rate",
            )
            for name, (df, measure, failed) in measured.items()
        ]
    )


@query
def dimension_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that a dimension run alone flags, by dimension and flag."""
    bronze = _bronze(spark, folder)
    flagged = {
        checks.COMPLETENESS: dimensions.completeness(bronze),
        checks.UNIQUENESS: dimensions.uniqueness(bronze),
        checks.TYPE_VALIDATION: dimensions.type_validation(bronze, AS_OF),
        checks.REFERENTIAL: dimensions.referential_integrity(bronze),
    }
    return metrics.union_all(
        [
            frames["orders"].groupBy(F.lit(column).alias("dimension"), F.col(column).alias("flag")).agg(
                F.count(F.lit(1)).alias("row_count")
            )
            for column, (frames, _) in flagged.items()
        ]
    )


@query
def failures_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.failures_by_reason(_orders(spark, folder)).orderBy(F.desc("row_count"))


@query
def silver_pass_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.pass_summary(_silver_named(spark, folder))


@query
def overall_pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.overall_pass_rate(_silver_named(spark, folder))


@query
def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    bronze, silver = _bronze(spark, folder), _silver(spark, folder)
    return metrics.row_counts({"bronze": bronze, "silver": silver})


@query
def silver_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Product failures are expected from the injected defects; other tables have no expectation."""
    bronze = {f"silver_{name}": df for name, df in _bronze(spark, folder).items()}
    expected = star.clean_products(spark, folder).agg(
        F.lit("silver_products").alias("table_name"),
        F.count_if(F.expr("product_id % 400 = 17 OR product_id % 300 = 29")).alias("expected_failed"),
    )
    return metrics.silver_validation(bronze, _silver_named(spark, folder), expected)


# ---- gold --------------------------------------------------------------------------------------


@query
def gold_sales_by_product(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder)


@query
def gold_revenue_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _revenue(spark, folder)


@query
def gold_customer_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    return gold.customer_segmentation(_revenue(spark, folder))


@query
def customer_segment_rows(spark: SparkSession, folder: str) -> DataFrame:
    return gold.classified_customers(_revenue(spark, folder))


@query
def sales_by_product_lines(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder, "orders", "products")
    return gold.sales_by_product_lines(silver["orders"], silver["products"])


@query
def revenue_by_customer_ratio_aov(spark: SparkSession, folder: str) -> DataFrame:
    return gold.revenue_per_order(_revenue(spark, folder))


@query
def segmentation_value_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return _tiers(spark, folder)


@query
def gold_daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_trend(_orders(spark, folder))


@query
def gold_weekly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return gold.weekly_trend(_orders(spark, folder))


def _gold_totals(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder)
    parents = [
        reconcile.sold_products(silver["products"]),
        reconcile.buying_customers(silver["customers"], AS_OF),
    ]
    return reconcile.gold_totals(silver["orders"], parents)


@query
def gold_key_null_check(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.key_nulls_of_totals(_gold_totals(spark, folder))


@query
def gold_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.reconciled_totals(_gold_totals(spark, folder))


@query
def segment_total_check(spark: SparkSession, folder: str) -> DataFrame:
    silver = _silver(spark, folder, "orders", "customers")
    parents = [reconcile.buying_customers(silver["customers"], AS_OF)]
    return reconcile.segment_total_of(reconcile.gold_totals(silver["orders"], parents))


@query
def probe_null_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.null_order_values(_revenue(spark, folder))


# ---- dashboard ---------------------------------------------------------------------------------


@query
def dash_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_products(_sales(spark, folder))


@query
def dash_filtered_products(spark: SparkSession, folder: str) -> DataFrame:
    filters = DashboardFilters(category="ECONOMY", revenue_above=1000)
    return dashboard.top_products(_sales(spark, folder), filters)


@query
def dash_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_customers(_revenue(spark, folder))


@query
def dash_revenue_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.revenue_histogram(_revenue(spark, folder))


@query
def dash_hist_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    filters = DashboardFilters(customer_segments=("BUILDING", "MACHINERY"))
    return dashboard.revenue_histogram(_revenue(spark, folder), filters)


@query
def dash_hist_by_country(spark: SparkSession, folder: str) -> DataFrame:
    filters = DashboardFilters(country="NATION_7")
    return dashboard.revenue_histogram(_revenue(spark, folder), filters)


@query
def dash_histogram_design(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.revenue_histogram_design(_revenue(spark, folder))


@query
def dash_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.segmentation_breakdown(gold.customer_segmentation(_revenue(spark, folder)))


@query
def dash_filtered_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    filters = DashboardFilters(segment_types=("High-Value", "Repeat"), customers_above=10)
    return dashboard.segmentation_breakdown(
        gold.customer_segmentation(_revenue(spark, folder)), filters
    )


@query
def dash_monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.monthly_trend(_orders(spark, folder))


@query
def dash_filtered_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The last 365 days of completed orders."""
    filters = DashboardFilters(orders_from=AS_OF - timedelta(days=365), order_status="Completed")
    return dashboard.monthly_trend(_orders(spark, folder), filters)


@query
def dash_trend_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.monthly_trend_sql(
        _orders(spark, folder), date(1997, 3, 15), date(1999, 10, 31)
    )


@query
def dash_segment_share(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.tier_shares(_tiers(spark, folder))


@query
def dash_category_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.category_breakdown(_sales(spark, folder))


@query
def dash_revenue_concentration(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.revenue_concentration(_revenue(spark, folder))
