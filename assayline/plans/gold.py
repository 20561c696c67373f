"""Gold aggregates over passing Silver rows.

Orders are aggregated per key before they meet their parents: a key that owns a third of the orders
leaves each map task as one row, and the join sees one row per key instead of one per order.

Orders that carry the uniqueness flag hold each order_id once among those that pass, so the distinct
count is a plain count, which combines before the shuffle. Without the flag orders are counted as
distinct values, at the cost of one shuffled row per order. ``unique_orders`` states it either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.functions import classify
from assayline.operators.checks import UNIQUENESS, passing
from assayline.specs import MONEY


def order_count(orders: DataFrame, unique_orders: bool | None = None) -> Column:
    """Distinct orders; a plain count where the caller, or the uniqueness flag, says none repeats."""
    unique = UNIQUENESS in orders.columns if unique_orders is None else unique_orders
    return F.count("order_id") if unique else F.count_distinct("order_id")


def money(column: Column) -> Column:
    return column.cast(MONEY)


def mean(total: Column, rows: Column) -> Column:
    return F.round(F.try_divide(total.cast("double"), rows.cast("double")), 4)


def _margin(price: Column, cost: Column) -> Column:
    list_price = price.cast("double")
    return F.round(F.try_divide(list_price - cost.cast("double"), list_price) * F.lit(100.0), 2)


def _sold_per_product(orders: DataFrame, products: DataFrame, unique_orders: bool | None) -> DataFrame:
    sold = (
        passing(orders)
        .groupBy("product_id")
        .agg(
            order_count(orders, unique_orders).alias("orders"),
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amounts"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced"),
        )
    )
    catalogue = passing(products).select("product_id", "product_name", "category", "price", "cost")
    return (
        sold.join(catalogue, "product_id")
        .groupBy("product_id", "product_name", "category")
        .agg(
            F.max("orders").alias("total_orders"),
            *[
                F.sum(c).alias(c)
                for c in ("lines", "quantity", "revenue", "amounts", "prices", "priced")
            ],
            F.max("price").alias("price"),
            F.max("cost").alias("cost"),
        )
    )


def sales_by_product(
    orders: DataFrame, products: DataFrame, unique_orders: bool | None = None
) -> DataFrame:
    """One row per product sold: orders, units, revenue, mean order amount, catalogue margin."""
    return _sold_per_product(orders, products, unique_orders).select(
        "product_id",
        "product_name",
        "category",
        "total_orders",
        F.col("quantity").alias("total_quantity"),
        money(F.col("revenue")).alias("total_revenue"),
        mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value"),
        _margin(F.col("price"), F.col("cost")).alias("profit_margin"),
    )


def sales_by_product_lines(orders: DataFrame, products: DataFrame) -> DataFrame:
    """The documented variant: order lines and mean unit price."""
    return _sold_per_product(orders, products, None).select(
        "product_id",
        "product_name",
        "category",
        F.col("quantity").alias("total_quantity_sold"),
        money(F.col("revenue")).alias("total_revenue"),
        F.col("lines").alias("order_line_count"),
        mean(F.col("prices"), F.col("priced")).alias("avg_unit_price"),
    )


def _bought_per_customer(orders: DataFrame, unique_orders: bool | None) -> DataFrame:
    return (
        passing(orders)
        .groupBy("customer_id")
        .agg(
            order_count(orders, unique_orders).alias("orders"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amounts"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


CUSTOMER_COLUMNS = ("customer_id", "customer_name", "customer_segment", "country")


def revenue_by_customer(
    orders: DataFrame, customers: DataFrame, as_of: date, unique_orders: bool | None = None
) -> DataFrame:
    """One row per customer with a passing order: orders, revenue, recency."""
    buyers = passing(customers).select(*CUSTOMER_COLUMNS)
    merged = (
        _bought_per_customer(orders, unique_orders)
        .join(buyers, "customer_id")
        .groupBy(*CUSTOMER_COLUMNS)
        .agg(
            F.max("orders").alias("total_orders"),
            F.sum("revenue").alias("revenue"),
            F.sum("amounts").alias("amounts"),
            F.min("first_order").alias("first_order_date"),
            F.max("last_order").alias("last_order_date"),
        )
    )
    return merged.select(
        *CUSTOMER_COLUMNS,
        "total_orders",
        money(F.col("revenue")).alias("total_revenue"),
        mean(F.col("revenue"), F.col("amounts")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        money(F.col("revenue")).alias("lifetime_value_actual"),
        F.datediff(F.lit(as_of), F.col("last_order_date")).alias("days_since_last_order"),
    )


def revenue_per_order(revenue: DataFrame) -> DataFrame:
    """The documented variant of the customer table: average order value as revenue per order."""
    return revenue.select(
        "customer_id",
        "customer_name",
        "country",
        "total_orders",
        "total_revenue",
        mean(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
    )


def classified_customers(revenue: DataFrame, segment: Column | None = None) -> DataFrame:
    """Each customer with its behavioural segment."""
    return revenue.select(
        "customer_id",
        "total_orders",
        "total_revenue",
        (classify.customer_segment() if segment is None else segment).alias("segment_type"),
    )


def share_of_all(rows: Column, digits: int) -> Column:
    """Percentage of the sum over all rows of a frame that holds a handful of classes."""
    everything = F.sum(rows).over(Window.partitionBy(F.lit(1)))
    return F.round(F.lit(100.0) * rows / everything, digits)


def customer_segmentation(revenue: DataFrame, segment: Column | None = None) -> DataFrame:
    """One row per segment. The total is summed from the segment rows, so customers are read once."""
    grouped = (
        classified_customers(revenue, segment)
        .groupBy("segment_type")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("total_revenue").alias("revenue"),
            F.sum("total_orders").alias("orders"),
        )
    )
    return grouped.select(
        "segment_type",
        "customer_count",
        mean(F.col("revenue"), F.col("customer_count")).alias("avg_revenue"),
        money(F.col("revenue")).alias("total_revenue"),
        mean(F.col("orders"), F.col("customer_count")).alias("avg_orders"),
        share_of_all(F.col("customer_count"), 2).alias("pct_of_total_customers"),
    )


def value_tiers(
    orders: DataFrame,
    customers: DataFrame,
    tiers: Sequence[tuple[int, str]] = fixed.VALUE_TIERS,
    unique_orders: bool | None = None,
) -> DataFrame:
    """Every passing customer with its revenue tier, also those who never bought."""
    bought = _bought_per_customer(orders, unique_orders).select("customer_id", "orders", "revenue")
    revenue = F.coalesce(money(F.col("revenue")), F.lit(0).cast(MONEY))
    order_total = F.coalesce(F.col("orders"), F.lit(0))
    return (
        passing(customers)
        .select(*CUSTOMER_COLUMNS)
        .join(bought, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "country",
            revenue.alias("total_revenue"),
            order_total.alias("total_orders"),
            classify.value_tier(revenue, order_total, tiers).alias("revenue_segment"),
            F.col("customer_segment").alias("source_customer_segment"),
        )
    )


def daily_trend(orders: DataFrame) -> DataFrame:
    """Orders and revenue per day, with its calendar year and ISO week."""
    day = F.to_date("order_date")
    return (
        passing(orders)
        .groupBy(day.alias("order_day"))
        .agg(
            F.count("order_id").alias("order_count"),
            money(F.sum("total_amount")).alias("daily_revenue"),
        )
        .select(
            "order_day",
            F.year("order_day").alias("year"),
            F.weekofyear("order_day").alias("week"),
            "order_count",
            "daily_revenue",
        )
    )


def weekly_trend(orders: DataFrame) -> DataFrame:
    """Orders and revenue per week, named by its Monday."""
    return (
        passing(orders)
        .groupBy(F.date_trunc("week", "order_date").cast("date").alias("week_start"))
        .agg(
            F.count("order_id").alias("order_count"),
            money(F.sum("total_amount")).alias("weekly_revenue"),
        )
    )
