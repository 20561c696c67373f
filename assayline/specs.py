"""Table specifications: schema, keys, rules and foreign keys of each source table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import types as T

from assayline.functions import rules


@dataclass(frozen=True)
class Rule:
    """A validity rule of one field; ``valid`` builds the Column for an evaluation day."""

    field: str
    reason: str
    label: str
    valid: Callable[[date], Column]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: str
    completeness: tuple[str, ...]
    required: tuple[str, ...]
    rules: tuple[Rule, ...]
    extended_rules: tuple[Rule, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def source_file(self) -> str:
        return f"{self.name}.csv"

    @property
    def bronze(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver(self) -> str:
        return f"silver_{self.name}"


def _column(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment})


def _email(field: str) -> Rule:
    return Rule(field, "invalid email format", "email format", lambda _: rules.valid_email(field))


def _past_date(field: str) -> Rule:
    return Rule(
        field,
        "invalid or future date",
        "valid date not in future",
        lambda as_of: rules.date_not_after(field, as_of),
    )


def _date(field: str) -> Rule:
    return Rule(field, "invalid date", "valid date", lambda _: rules.valid_date(field))


def _numeric(field: str) -> Rule:
    return Rule(field, "must be numeric", "numeric", lambda _: rules.numeric(field))


def _amount(field: str) -> Rule:
    return Rule(
        field, "must be non-negative decimal", "non-negative decimal",
        lambda _: rules.non_negative_number(field),
    )


def _count(field: str) -> Rule:
    return Rule(
        field, "must be non-negative integer", "non-negative integer",
        lambda _: rules.non_negative_integer(field),
    )


def _quantity(field: str) -> Rule:
    return Rule(
        field, "must be positive integer", "positive integer",
        lambda _: rules.positive_integer(field),
    )


MONEY = T.DecimalType(18, 2)

CUSTOMERS = TableSpec(
    name="customers",
    schema=T.StructType(
        [
            _column("customer_id", T.LongType(), "Customer key"),
            _column("customer_name", T.StringType(), "Full name"),
            _column("email", T.StringType(), "Contact address, may be missing in the extract"),
            _column("country", T.StringType(), "Country of the customer"),
            _column("signup_date", T.DateType(), "Day the account was opened"),
            _column("customer_segment", T.StringType(), "Marketing segment given by the source"),
            _column("lifetime_value", MONEY, "Lifetime value given by the source"),
        ]
    ),
    primary_key="customer_id",
    completeness=("email",),
    required=("customer_id", "customer_name", "email", "country", "signup_date"),
    rules=(_email("email"), _past_date("signup_date")),
    extended_rules=(_email("email"), _date("signup_date"), _numeric("lifetime_value")),
)

PRODUCTS = TableSpec(
    name="products",
    schema=T.StructType(
        [
            _column("product_id", T.LongType(), "Product key"),
            _column("product_name", T.StringType(), "Display name"),
            _column("category", T.StringType(), "Catalogue category"),
            _column("price", MONEY, "List price"),
            _column("cost", MONEY, "Unit cost"),
            _column("stock_quantity", T.IntegerType(), "Units in stock"),
            _column("reorder_level", T.IntegerType(), "Stock level that triggers a reorder"),
        ]
    ),
    primary_key="product_id",
    completeness=(),
    required=("product_id", "product_name", "category", "price"),
    rules=(
        Rule("price", "must be positive", "positive price", lambda _: rules.positive_number("price")),
        Rule(
            "cost",
            "must be positive and less than price",
            "positive and less than price",
            lambda _: rules.cost_below_price("cost", "price"),
        ),
    ),
    extended_rules=(
        _amount("price"),
        _amount("cost"),
        _count("stock_quantity"),
        _count("reorder_level"),
    ),
)

ORDERS = TableSpec(
    name="orders",
    schema=T.StructType(
        [
            _column("order_id", T.LongType(), "Order key"),
            _column("customer_id", T.LongType(), "Customer who ordered"),
            _column("order_date", T.DateType(), "Day of the order"),
            _column("product_id", T.LongType(), "Product ordered"),
            _column("quantity", T.IntegerType(), "Units ordered"),
            _column("unit_price", MONEY, "Price per unit on the day of the order"),
            _column("total_amount", MONEY, "Quantity times unit price"),
            _column("order_status", T.StringType(), "Completed, Pending or Cancelled"),
            _column("payment_date", T.DateType(), "Day of payment, if any"),
        ]
    ),
    primary_key="order_id",
    completeness=("customer_id", "product_id"),
    required=(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "quantity",
        "unit_price",
        "total_amount",
        "order_status",
    ),
    rules=(
        _quantity("quantity"),
        Rule(
            "total_amount", "must be positive decimal", "positive decimal",
            lambda _: rules.positive_number("total_amount"),
        ),
        _past_date("order_date"),
    ),
    extended_rules=(
        _quantity("quantity"),
        _amount("unit_price"),
        _amount("total_amount"),
        _date("order_date"),
        _date("payment_date"),
    ),
    foreign_keys=(
        ForeignKey("customer_id", "customers", "customer_id"),
        ForeignKey("product_id", "products", "product_id"),
    ),
)

# Parents are landed before the orders that refer to them.
TABLES = (CUSTOMERS, PRODUCTS, ORDERS)
