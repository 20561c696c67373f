"""Dashboard queries over Gold tables and passing Silver orders, with optional filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.functions import classify
from assayline.operators.checks import passing
from assayline.operators.checks import UNIQUENESS
from assayline.plans.gold import money, order_count, share_of_all


@dataclass(frozen=True)
class DashboardFilters:
    """Filters a dashboard may set; unset ones do not filter."""

    category: str | None = None
    revenue_above: float | None = None
    country: str | None = None
    customer_segments: Sequence[str] | None = None
    segment_types: Sequence[str] | None = None
    customers_above: int | None = None
    orders_from: date | None = None
    orders_to: date | None = None
    order_status: str | None = None

    def apply(self, df: DataFrame, **columns: str) -> DataFrame:
        """Filter ``df`` by the named filters; each keyword maps a filter to a column."""
        tests = {
            "category": lambda c, v: c == v,
            "revenue_above": lambda c, v: c > v,
            "country": lambda c, v: c == v,
            "customer_segments": lambda c, v: c.isin(*v),
            "segment_types": lambda c, v: c.isin(*v),
            "customers_above": lambda c, v: c > v,
            "orders_from": lambda c, v: c >= F.lit(v),
            "orders_to": lambda c, v: c <= F.lit(v),
            "order_status": lambda c, v: c == v,
        }
        for name, column in columns.items():
            value = getattr(self, name)
            if value is not None:
                df = df.filter(tests[name](F.col(column), value))
        return df


NO_FILTERS = DashboardFilters()


def top_products(
    sales: DataFrame, filters: DashboardFilters = NO_FILTERS, limit: int = 10
) -> DataFrame:
    """Products by revenue, ties by product_id."""
    shown = filters.apply(sales, category="category", revenue_above="total_revenue")
    return (
        shown.orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
        .select("product_name", "category", "total_revenue", "total_quantity", "total_orders")
    )


def top_customers(
    revenue: DataFrame, filters: DashboardFilters = NO_FILTERS, limit: int = 15
) -> DataFrame:
    """Customers by revenue, ties by customer_id."""
    shown = filters.apply(revenue, country="country", customer_segments="customer_segment")
    return (
        shown.orderBy(F.desc("total_revenue"), "customer_id")
        .limit(limit)
        .select("customer_id", "customer_name", "country", "total_orders", "total_revenue")
    )


def revenue_histogram(
    revenue: DataFrame,
    filters: DashboardFilters = NO_FILTERS,
    edges: Sequence[tuple[int, str]] = fixed.REVENUE_BUCKETS,
    last: str = fixed.LAST_REVENUE_BUCKET,
) -> DataFrame:
    """Customers per revenue bucket, in bucket order."""
    shown = filters.apply(revenue, country="country", customer_segments="customer_segment")
    label = classify.bucket_label(F.col("total_revenue"), edges, last)
    return (
        shown.groupBy(label.alias("revenue_bucket"))
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .withColumn("bucket_order", classify.bucket_order(F.col("revenue_bucket"), edges, last))
        .orderBy("bucket_order")
    )


def revenue_histogram_design(revenue: DataFrame) -> DataFrame:
    """The documented five-bucket histogram, ordered by the smallest revenue of each bucket."""
    label = classify.bucket_label(
        F.col("total_revenue"), fixed.DESIGN_BUCKETS, fixed.LAST_DESIGN_BUCKET
    )
    return (
        revenue.groupBy(label.alias("revenue_bucket"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"), F.min("total_revenue").alias("min_revenue")
        )
        .orderBy("min_revenue")
    )


def segmentation_breakdown(
    segmentation: DataFrame, filters: DashboardFilters = NO_FILTERS
) -> DataFrame:
    shown = filters.apply(
        segmentation, segment_types="segment_type", customers_above="customer_count"
    )
    return shown.select(
        "segment_type",
        "customer_count",
        "pct_of_total_customers",
        "total_revenue",
        "avg_revenue",
        "avg_orders",
    ).orderBy(F.desc("customer_count"), "segment_type")


def monthly_trend(
    orders: DataFrame, filters: DashboardFilters = NO_FILTERS, unique_orders: bool | None = None
) -> DataFrame:
    """Revenue and distinct orders per month of the passing orders; parents play no part."""
    shown = filters.apply(
        passing(orders),
        orders_from="order_date",
        orders_to="order_date",
        order_status="order_status",
    )
    return (
        shown.groupBy(F.date_trunc("month", "order_date").cast("date").alias("month"))
        .agg(
            F.sum("total_amount").cast("double").alias("monthly_revenue"),
            order_count(orders, unique_orders).alias("monthly_orders"),
        )
        .orderBy("month")
    )


def monthly_trend_sql(orders: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """The monthly trend as SQL with named parameters, as a dashboard widget binds them."""
    counted = "order_id" if UNIQUENESS in orders.columns else "DISTINCT order_id"
    return orders.sparkSession.sql(
        f"""
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
               CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue,
               count({counted}) AS monthly_orders
        FROM {{orders}}
        WHERE quality_check_result = 'PASS' AND order_date BETWEEN :date_from AND :date_to
        GROUP BY 1
        ORDER BY 1
        """,
        args={"date_from": date_from, "date_to": date_to},
        orders=orders,
    )


def tier_shares(tiers: DataFrame) -> DataFrame:
    """Customers per value tier and their share."""
    return (
        tiers.groupBy("revenue_segment")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .withColumn("pct_of_customers", share_of_all(F.col("customer_count"), 1))
        .orderBy(F.desc("customer_count"), "revenue_segment")
    )


def category_breakdown(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_quantity").alias("total_quantity"),
            money(F.sum("total_revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def revenue_concentration(
    revenue: DataFrame,
    edges: Sequence[tuple[int, str]] = fixed.REVENUE_BUCKETS,
    last: str = fixed.LAST_REVENUE_BUCKET,
) -> DataFrame:
    """How much of all revenue comes from the best customers, bucket by bucket from the top.

    Customers are grouped into the fixed revenue buckets first; the running sum covers only those.
    """
    label = classify.bucket_label(F.col("total_revenue"), edges, last)
    buckets = (
        revenue.groupBy(label.alias("revenue_bucket"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("total_revenue").alias("revenue"),
        )
        .withColumn("bucket_order", classify.bucket_order(F.col("revenue_bucket"), edges, last))
    )
    everything = Window.partitionBy(F.lit(1))
    from_top = everything.orderBy(F.desc("bucket_order")).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("revenue").over(everything).cast("double")
    running = F.sum("revenue").over(from_top).cast("double")
    return buckets.select(
        "revenue_bucket",
        "bucket_order",
        "customer_count",
        money(F.col("revenue")).alias("total_revenue"),
        F.round(F.try_divide(F.col("revenue").cast("double") * 100.0, total), 2).alias(
            "pct_of_revenue"
        ),
        F.round(F.try_divide(running * 100.0, total), 2).alias("cumulative_pct"),
    ).orderBy(F.desc("bucket_order"))
