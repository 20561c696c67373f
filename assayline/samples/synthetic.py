"""Generated customers, products and orders of any size.

Rows come from ``spark.range``; every value is a hash of the row's key and a seed, so a table of any
size is generated in parallel and is the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.functions.classify import first_match
from assayline.samples.defects import Defect
from assayline.specs import MONEY

# ---- fixed values: words, weights (percent) and ranges of the sample data ----------------------
COUNTRIES = ("USA", "UK", "Canada", "Germany", "France", "Australia", "India")
SEGMENTS = (("Premium", 20), ("Standard", 50), ("Basic", 30))
LIFETIME_VALUES = {"Premium": (5000, 50_000), "Standard": (1000, 5000), "Basic": (100, 1000)}
CATEGORIES = ("Electronics", "Clothing", "Home", "Sports", "Books", "Beauty", "Food", "Toys")
STATUSES = (("Completed", 70), ("Pending", 20), ("Cancelled", 10))
EMAIL_DOMAINS = ("example.com", "shopmail.com", "ecommerce.io", "customer.net")
SIGNUP_RANGE = (date(2020, 1, 1), date(2024, 12, 31))
ORDER_RANGE = (date(2023, 1, 1), date(2024, 12, 31))
PRICE_CENTS = (999, 99_999)
COST_PERCENT = (30, 70)
ORPHAN_CUSTOMERS_FROM = 99_901
ORPHAN_PRODUCTS_FROM = 9_901


def _draw(key: Column, seed: int, what: str, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return low + F.pmod(F.xxhash64(key, F.lit(f"{seed}:{what}")), F.lit(high - low + 1))


def _pick(key: Column, seed: int, what: str, words: Sequence[str]) -> Column:
    index = _draw(key, seed, what, 1, len(words)).cast("int")
    return F.element_at(F.array(*[F.lit(w) for w in words]), index)


def _weighted(key: Column, seed: int, what: str, choices: Sequence[tuple[str, int]]) -> Column:
    drawn, below, cases = _draw(key, seed, what, 0, 99), 0, []
    for word, weight in choices:
        below += weight
        cases.append((drawn < below, word))
    return first_match(cases[:-1], choices[-1][0])


def _day(key: Column, seed: int, what: str, first: date, last: date) -> Column:
    return F.date_add(F.lit(first), _draw(key, seed, what, 0, (last - first).days).cast("int"))


def _cents(value: Column) -> Column:
    return (value.cast("decimal(18,0)") / 100).cast(MONEY)


def _price_cents(product: Column, seed: int) -> Column:
    return _draw(product, seed, "price", *PRICE_CENTS)


def products(spark: SparkSession, rows: int = 500, seed: int = 42) -> DataFrame:
    key = F.col("id")
    price = _price_cents(key, seed)
    cost = F.floor(price * _draw(key, seed, "cost", *COST_PERCENT) / 100)
    return spark.range(1, rows + 1).select(
        key.alias("product_id"),
        F.concat(F.lit("Product "), key).alias("product_name"),
        _pick(key, seed, "category", CATEGORIES).alias("category"),
        _cents(price).alias("price"),
        _cents(cost).alias("cost"),
        _draw(key, seed, "stock", 0, 1000).cast("int").alias("stock_quantity"),
        _draw(key, seed, "reorder", 10, 100).cast("int").alias("reorder_level"),
    )


def customers(spark: SparkSession, rows: int = 10_000, seed: int = 42) -> DataFrame:
    key = F.col("id")
    value = first_match(
        [
            (
                F.col("customer_segment") == segment,
                _cents(_draw(key, seed, f"value {segment}", low * 100, high * 100)),
            )
            for segment, (low, high) in LIFETIME_VALUES.items()
        ],
        F.lit(None).cast(MONEY),
    )
    return (
        spark.range(1, rows + 1)
        .withColumn("customer_segment", _weighted(key, seed, "segment", SEGMENTS))
        .select(
            key.alias("customer_id"),
            F.concat(F.lit("Customer "), key).alias("customer_name"),
            F.concat(
                F.lit("customer."), key, F.lit("@"), _pick(key, seed, "domain", EMAIL_DOMAINS)
            ).alias("email"),
            _pick(key, seed, "country", COUNTRIES).alias("country"),
            _day(key, seed, "signup", *SIGNUP_RANGE).alias("signup_date"),
            "customer_segment",
            value.alias("lifetime_value"),
        )
    )


def orders(
    spark: SparkSession,
    rows: int = 100_000,
    customer_rows: int = 10_000,
    product_rows: int = 500,
    seed: int = 42,
) -> DataFrame:
    """Orders whose price is that of their product, computed from its key without a join."""
    key = F.col("id")
    paid = F.date_add("order_date", _draw(key, seed, "payment", 0, 7).cast("int"))
    return (
        spark.range(1, rows + 1)
        .withColumns(
            {
                "product_id": _draw(key, seed, "product", 1, product_rows),
                "quantity": _draw(key, seed, "quantity", 1, 10).cast("int"),
                "order_date": _day(key, seed, "order", *ORDER_RANGE),
                "order_status": _weighted(key, seed, "status", STATUSES),
            }
        )
        .withColumn("_price", _price_cents(F.col("product_id"), seed))
        .select(
            key.alias("order_id"),
            _draw(key, seed, "customer", 1, customer_rows).alias("customer_id"),
            "order_date",
            "product_id",
            "quantity",
            _cents(F.col("_price")).alias("unit_price"),
            _cents(F.col("_price") * F.col("quantity")).alias("total_amount"),
            "order_status",
            F.when(F.col("order_status") == "Completed", paid).alias("payment_date"),
        )
    )


def synthetic_tables(
    spark: SparkSession,
    customer_rows: int = 10_000,
    order_rows: int = 100_000,
    product_rows: int = 500,
    seed: int = 42,
) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, customer_rows, seed),
        "products": products(spark, product_rows, seed),
        "orders": orders(spark, order_rows, customer_rows, product_rows, seed),
    }


# The defects of the sample data at its default size. NULL and orphan defects hit disjoint rows.
CUSTOMER_DEFECTS = (
    Defect("NULL email", "email", "customer_id % 200 = 3", "NULL"),
    Defect("duplicate customer_id", "customer_id", "customer_id % 1000 = 7", "customer_id + 1"),
)
ORDER_DEFECTS = (
    Defect("NULL customer_id", "customer_id", "order_id % 1000 = 21", "NULL"),
    Defect(
        "orphan customer_id",
        "customer_id",
        "order_id % 2000 = 42",
        f"{ORPHAN_CUSTOMERS_FROM} + order_id div 2000",
    ),
    Defect("NULL product_id", "product_id", "order_id % 500 = 33", "NULL"),
    Defect(
        "orphan product_id",
        "product_id",
        "order_id % 3333 = 78",
        f"{ORPHAN_PRODUCTS_FROM} + order_id div 3333",
    ),
    Defect("duplicate order_id", "order_id", "order_id % 10000 = 5", "order_id - 1"),
)
