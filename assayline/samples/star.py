"""The three source tables derived from a star schema's customer, nation, part and orders.

The star schema is clean, so fixed defects are injected; see ``FIXTURES.md``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.functions.classify import first_match
from assayline.samples.defects import Defect, inject_defects
from assayline.specs import MONEY

AS_OF = date(2001, 8, 2)

CUSTOMER_DEFECTS = (
    Defect("duplicate customer_id", "customer_id", "customer_id % 150 = 7", "customer_id - 1"),
    Defect("NULL email", "email", "customer_id % 30 = 3", "NULL"),
    Defect("malformed email", "email", "customer_id % 200 = 11", "'not-an-email'"),
    Defect("future signup_date", "signup_date", "customer_id % 500 = 13", "DATE '2099-01-01'"),
)
PRODUCT_DEFECTS = (
    Defect("zero price", "price", "product_id % 400 = 17", "0"),
    Defect("cost above price", "cost", "product_id % 300 = 29", "999"),
    Defect("NULL cost", "cost", "product_id % 250 = 31", "NULL"),
)
ORDER_DEFECTS = (
    Defect("duplicate order_id", "order_id", "order_id % 1500 = 5", "order_id - 1"),
    Defect("NULL customer_id", "customer_id", "order_id % 1000 = 21", "NULL"),
    Defect("orphan customer_id", "customer_id", "order_id % 2000 = 42", "90000000 + order_id"),
    Defect("future order_date", "order_date", "order_id % 4000 = 123", "DATE '2099-01-01'"),
    Defect("NULL product_id", "product_id", "order_id % 500 = 33", "NULL"),
    Defect("orphan product_id", "product_id", "order_id % 3000 = 77", "90000000 + order_id"),
    Defect("zero quantity", "quantity", "order_id % 2500 = 99", "0"),
    Defect("negative total_amount", "total_amount", "order_id % 3500 = 150", "-1"),
)


_SCHEMAS: dict[str, T.StructType] = {}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the schema; its columns are read from its footers once, as that is a job of its own."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def clean_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = _read(spark, folder, "customer"), _read(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
            "email"
        ),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("c_custkey") % 1800).cast("int")).alias(
            "signup_date"
        ),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_acctbal").cast(MONEY).alias("lifetime_value"),
    )


def clean_products(spark: SparkSession, folder: str) -> DataFrame:
    list_price, key = F.floor("p_retailprice"), F.col("p_partkey")
    return _read(spark, folder, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        (list_price / 10).cast(MONEY).alias("price"),
        (list_price * (3 + key % 5) / 100).cast(MONEY).alias("cost"),
        (F.col("p_size") * 20).alias("stock_quantity"),
        (10 + key % 91).cast("int").alias("reorder_level"),
    )


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Each order of the star schema as one order line of a product chosen by its key."""
    part = _read(spark, folder, "part").select("p_partkey", F.floor("p_retailprice").alias("_price"))
    key = F.col("o_orderkey")
    orders = _read(spark, folder, "orders").withColumn(
        "_part", (key * 7) % part.agg(F.count(F.lit(1))).scalar()
    )
    units, status = 1 + key % 10, F.col("o_orderstatus")
    day = F.col("o_orderdate").cast("date")
    paid = F.when(status == "F", F.date_add(day, (key % 8).cast("int")))
    return orders.join(part, F.col("_part") == F.col("p_partkey")).select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day.alias("order_date"),
        F.col("p_partkey").alias("product_id"),
        units.cast("int").alias("quantity"),
        (F.col("_price") / 10).cast(MONEY).alias("unit_price"),
        (F.col("_price") * units / 10).cast(MONEY).alias("total_amount"),
        first_match([(status == "F", "Completed"), (status == "O", "Pending")], "Cancelled").alias(
            "order_status"
        ),
        paid.alias("payment_date"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return inject_defects(clean_customers(spark, folder), CUSTOMER_DEFECTS)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return inject_defects(clean_products(spark, folder), PRODUCT_DEFECTS)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return inject_defects(clean_orders(spark, folder), ORDER_DEFECTS)


BUILDERS = {"customers": customers, "products": products, "orders": orders}


def source_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: build(spark, folder) for name, build in BUILDERS.items()}
