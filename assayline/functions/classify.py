"""Classifications as ``CASE`` Columns: buckets, segments, tiers, alert levels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline import fixed_values as fixed


def first_match(cases: Iterable[tuple[Column, Column | str]], otherwise: Column | str | None) -> Column:
    """One flat CASE: the first true condition names the result."""

    def as_column(value: Column | str | None) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    chain = None
    for condition, value in cases:
        branch = F if chain is None else chain
        chain = branch.when(condition, as_column(value))
    return as_column(otherwise) if chain is None else chain.otherwise(as_column(otherwise))


def bucket_label(value: Column, edges: Sequence[tuple[int, str]], last: str) -> Column:
    """Half-open buckets; values below the first edge fall in the first, NULL in the last."""
    return first_match([(value < edge, label) for edge, label in edges], last)


def bucket_order(label: Column, edges: Sequence[tuple[int, str]], last: str) -> Column:
    labels = [name for _, name in edges] + [last]
    return first_match(
        [(label == name, F.lit(position)) for position, name in enumerate(labels, start=1)],
        F.lit(len(labels) + 1),
    )


def customer_segment(
    inactive_after: int = fixed.INACTIVE_AFTER_DAYS,
    high_revenue: int = fixed.HIGH_VALUE_ABOVE_REVENUE,
    high_orders: int = fixed.HIGH_VALUE_ABOVE_ORDERS,
    repeat_from: int = fixed.REPEAT_FROM_ORDERS,
    repeat_to: int = fixed.REPEAT_TO_ORDERS,
    revenue: Column | None = None,
    age: Column | None = None,
) -> Column:
    """Behavioural segment of a row of customer revenue, or of the given revenue and days since the last order."""
    orders = F.col("total_orders")
    revenue = F.col("total_revenue") if revenue is None else revenue
    age = F.col("days_since_last_order") if age is None else age
    return first_match(
        [
            (age > inactive_after, "Inactive"),
            ((revenue > high_revenue) | (orders > high_orders), "High-Value"),
            (orders == 1, "One-Time"),
            (orders.between(repeat_from, repeat_to), "Repeat"),
        ],
        "Regular",
    )


def value_tier(
    revenue: Column, order_count: Column, tiers: Sequence[tuple[int, str]] = fixed.VALUE_TIERS
) -> Column:
    """Revenue tier; customers without an order come first."""
    cases = [(order_count == 0, fixed.NO_PURCHASE_TIER)]
    cases += [(revenue >= limit, name) for limit, name in tiers]
    return first_match(cases, fixed.LOWEST_TIER)


def alert_level(pass_rate: Column) -> Column:
    return first_match(
        [(pass_rate >= fixed.NORMAL_FROM, "normal"), (pass_rate >= fixed.WARNING_FROM, "warning")],
        "critical",
    )


def check_limit(check_type: Column) -> Column:
    """The pass rate a check has to reach; NULL where none is set."""
    cases = [(check_type == name, F.lit(limit)) for name, limit in fixed.CHECK_LIMITS.items()]
    return first_match(cases, F.lit(None).cast("double"))


def pass_rate(passed: Column, total: Column) -> Column:
    """Share of 1 with four digits; no rows count as passed."""
    return F.coalesce(F.round(F.try_divide(passed.cast("double"), total.cast("double")), 4), F.lit(1.0))


def pass_percent(failed: Column, total: Column) -> Column:
    """Percentage, unrounded; no rows count as 100."""
    share = F.try_divide((total - failed).cast("double"), total.cast("double"))
    return F.coalesce(share * F.lit(100.0), F.lit(100.0))
