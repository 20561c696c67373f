"""Reconciliation of Gold against Silver, and probes of finished tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.fixed_values import MOJIBAKE_MARK
from assayline.functions import classify
from assayline.operators import metrics
from assayline.operators.checks import passing
from assayline.plans import gold

TOTAL = "decimal(28,2)"
SALES, REVENUE, SEGMENTATION = "gold_sales_by_product", "gold_revenue_by_customer", "gold_customer_segmentation"


@dataclass(frozen=True)
class GoldParent:
    """The parent rows that a Gold table groups orders by: its key, all columns it groups by, those that
    must not be NULL, and the evaluation day if its rows are classified."""

    gold_table: str
    rows: DataFrame
    key: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    as_of: date | None = None


def sold_products(products: DataFrame) -> GoldParent:
    columns = ("product_id", "product_name", "category")
    return GoldParent(SALES, products, "product_id", columns, columns)


def buying_customers(customers: DataFrame, as_of: date) -> GoldParent:
    required = ("customer_id", "customer_name")
    return GoldParent(REVENUE, customers, "customer_id", gold.CUSTOMER_COLUMNS, required, as_of)


def _lost() -> dict[str, Column]:
    return {
        f"lost_to_failed_{parent}s": (F.col("silver_pass_revenue") - F.col(f"{parent}_revenue")).cast(TOTAL)
        for parent in ("product", "customer")
    }


def _total(df: DataFrame, column: str, name: str) -> DataFrame:
    total = F.coalesce(F.sum(column), F.lit(0)).cast(TOTAL)
    return df.agg(total.alias(name))


def revenue_reconciliation(orders: DataFrame, sales: DataFrame, revenue: DataFrame) -> DataFrame:
    """Passing Silver revenue against both Gold totals; the rest belongs to failed parents."""
    return (
        _total(passing(orders), "total_amount", "silver_pass_revenue")
        .crossJoin(F.broadcast(_total(sales, "total_revenue", "product_revenue")))
        .crossJoin(F.broadcast(_total(revenue, "total_revenue", "customer_revenue")))
        .withColumns(_lost())
    )


def gold_totals(orders: DataFrame, parents: Sequence[GoldParent]) -> DataFrame:
    """Passing orders summed by each parent's key in one pass, then folded to a few rows.

    One aggregate over grouping sets gives a row per key of each parent, so the orders are evaluated
    once however many Gold tables are asked about. Those rows meet the passing parents, and rows with
    the same ``gold_table``, ``matched`` and ``segment_type`` are folded into one: ``rows``,
    ``null_key_rows``, ``order_revenue`` of all keys and ``revenue`` of the Gold rows.
    """
    keys = [p.key for p in parents]
    sums = (
        passing(orders)
        .groupingSets([[k] for k in keys], *keys)
        .agg(
            *[F.grouping(k).alias(f"_other_{k}") for k in keys],
            gold.order_count(orders).alias("total_orders"),
            F.sum("total_amount").alias("_sum"),
            F.max("order_date").alias("_last"),
        )
    )
    own = {p.key: F.col(f"_other_{p.key}") == 0 for p in parents}
    matched, null_key, segment, name = F.lit(False), F.lit(False), F.lit(None).cast("string"), None
    revenue = gold.money(F.col("_sum") * F.coalesce(*[F.col(f"_times_{k}") for k in keys], F.lit(1)))
    for parent in parents:
        k, columns = parent.key, parent.columns
        once = passing(parent.rows).groupBy(*columns).agg(F.count(F.lit(1)).alias(f"_times_{k}"))
        named = once.toDF(*[f"_{k}_{c}" for c in columns], f"_times_{k}")
        sums = sums.join(named, F.col(k) == F.col(f"_{k}_{k}"), "left")
        held = own[k] & F.col(f"_times_{k}").isNotNull()
        missing = reduce(or_, [F.col(f"_{k}_{c}").isNull() for c in parent.required]) | F.col("_sum").isNull()
        matched, null_key = matched | held, null_key | (held & missing)
        name = (F if name is None else name).when(own[k], F.lit(parent.gold_table))
        if parent.as_of is not None:
            age = F.datediff(F.lit(parent.as_of), F.col("_last"))
            segment = F.when(held, classify.customer_segment(revenue=F.col("_revenue"), age=age))
    return (
        sums.withColumn("_revenue", revenue)
        .groupBy(name.alias("gold_table"), matched.alias("matched"), segment.alias("segment_type"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(null_key).alias("null_key_rows"),
            F.sum("_sum").cast(TOTAL).alias("order_revenue"),
            F.sum("_revenue").cast(TOTAL).alias("revenue"),
        )
    )


def reconciled_totals(totals: DataFrame, sales: str = SALES, revenue: str = REVENUE) -> DataFrame:
    """:func:`revenue_reconciliation` from :func:`gold_totals` of products and customers."""

    def total(condition: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast(TOTAL)

    of = F.col("gold_table")
    return totals.agg(
        total(of == sales, "order_revenue").alias("silver_pass_revenue"),
        total((of == sales) & F.col("matched"), "revenue").alias("product_revenue"),
        total((of == revenue) & F.col("matched"), "revenue").alias("customer_revenue"),
    ).withColumns(_lost())


def key_nulls_of_totals(
    totals: DataFrame, tables: Sequence[str] = (SALES, REVENUE), segmentation: str = SEGMENTATION
) -> DataFrame:
    """Rows and rows with a NULL key of each Gold table, the one of segments included."""

    def total(column: str, table: str) -> Column:
        of_table = F.col("matched") & (F.col("gold_table") == table)
        return F.coalesce(F.sum(F.when(of_table, F.col(column))), F.lit(0))

    segment = F.col("matched") & F.col("segment_type").isNotNull()
    measures = {segmentation: (F.count_if(segment), F.count_if(segment & F.col("revenue").isNull()))}
    measures |= {t: (total("rows", t), total("null_key_rows", t)) for t in tables}
    counted = totals.agg(
        *[m.alias(f"{kind}_{t}") for t, pair in measures.items() for kind, m in zip(("rows", "nulls"), pair)]
    )
    return metrics.rows_of(
        counted,
        [
            {"table_name": F.lit(t), "row_count": F.col(f"rows_{t}"), "null_key_rows": F.col(f"nulls_{t}")}
            for t in measures
        ],
    )


def segment_total_of(totals: DataFrame, revenue: str = REVENUE) -> DataFrame:
    """:func:`segment_total_check` from :func:`gold_totals` of customers."""
    own = (F.col("gold_table") == revenue) & F.col("matched")
    counted = totals.agg(
        F.coalesce(F.sum(F.when(own & F.col("segment_type").isNotNull(), F.col("rows"))), F.lit(0)).alias(
            "segmented_customers"
        ),
        F.coalesce(F.sum(F.when(own, F.col("rows"))), F.lit(0)).alias("customers_with_orders"),
    )
    return counted.withColumn("is_valid", F.col("segmented_customers") <= F.col("customers_with_orders"))


def segment_total_check(segmentation: DataFrame, revenue: DataFrame) -> DataFrame:
    """Customers counted by segment against customers with orders."""
    return (
        segmentation.agg(F.coalesce(F.sum("customer_count"), F.lit(0)).alias("segmented_customers"))
        .crossJoin(F.broadcast(revenue.agg(F.count(F.lit(1)).alias("customers_with_orders"))))
        .withColumn("is_valid", F.col("segmented_customers") <= F.col("customers_with_orders"))
    )


def null_order_values(revenue: DataFrame) -> DataFrame:
    """Customers, and those without an average order value."""
    return revenue.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("avg_order_value").isNull()).alias("null_avg_order_value"),
    )


def mojibake_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text shows UTF-8 read in the wrong encoding."""
    return df.filter(F.col(column).like(f"%{MOJIBAKE_MARK}%"))


def column_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type of each column over the rows of the table (NULL without rows), with its row and value counts."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_n_{c}") for c in columns],
        *[F.any_value(F.typeof(c)).alias(f"_type_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_type_{c}").alias("column_type"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n_{c}").alias("value_count"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))
