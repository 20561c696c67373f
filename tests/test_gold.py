"""Gold aggregates and dashboard queries on small frames, with skew and with brute force."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayline.operators import metrics
from assayline.operators.checks import UNIQUENESS
from assayline.plans import dashboard, gold, reconcile
from assayline.plans.dashboard import DashboardFilters
from tests.conftest import AS_OF, SMALL_TABLES, plan_text
from workload import queries as workload_queries

DAY = date(2024, 6, 1)


def make_orders(spark, rows):
    """Rows of (order_id, customer_id, product_id, quantity, amount, date, verdict)."""
    schema = (
        "order_id long, customer_id long, product_id long, quantity int, "
        "total_amount decimal(18,2), order_date date, quality_check_result string"
    )
    return spark.createDataFrame(rows, schema).select(
        "*",
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("unit_price"),
        F.lit("Completed").alias("order_status"),
    )


@pytest.fixture
def tables(spark):
    orders, key = [], 0
    for i in range(300):
        key += 1
        hot = i % 3 == 0
        orders.append(
            (key, 1 if hot else 1 + i % 17, 1 if hot else 1 + i % 11, 1 + i % 5,
             Decimal(10 + i % 7), DAY - timedelta(days=i % 400), "PASS" if i % 13 else "FAIL: x")
        )
    orders.append((key + 1, None, None, 1, Decimal(5), DAY, "PASS"))
    customers = spark.createDataFrame(
        [(i, f"c{i}", "S", "N", "PASS" if i != 5 else "FAIL: x") for i in range(1, 20)],
        "customer_id long, customer_name string, customer_segment string, country string, "
        "quality_check_result string",
    )
    products = spark.createDataFrame(
        [(i, f"p{i}", "A" if i % 2 else "B", Decimal(20), None if i == 3 else Decimal(5),
          "PASS" if i != 4 else "FAIL: x") for i in range(1, 13)],
        "product_id long, product_name string, category string, price decimal(18,2), "
        "cost decimal(18,2), quality_check_result string",
    )
    return {
        "rows": orders, "orders": make_orders(spark, orders), "customers": customers,
        "products": products,
    }


def brute(rows, position, failed):
    groups = defaultdict(list)
    for row in rows:
        if row[6] == "PASS" and row[position] is not None and row[position] not in failed:
            groups[row[position]].append(row)
    return groups


@pytest.mark.parametrize("unique_orders", [True, False])
def test_sales_by_product(tables, unique_orders):
    sales = gold.sales_by_product(tables["orders"], tables["products"], unique_orders)
    found = {r.product_id: r for r in sales.collect()}
    expected = brute(tables["rows"], 2, {4})
    assert set(found) == set(expected)
    for key, rows in expected.items():
        row = found[key]
        assert row.total_orders == len(rows)
        assert row.total_quantity == sum(r[3] for r in rows)
        assert row.total_revenue == sum(r[4] for r in rows)
        assert row.avg_order_value == pytest.approx(float(row.total_revenue) / len(rows), abs=1e-4)
        assert row.profit_margin == (None if key == 3 else 75.0)


@pytest.mark.parametrize("unique_orders", [True, False])
def test_revenue_by_customer(tables, unique_orders):
    revenue = gold.revenue_by_customer(tables["orders"], tables["customers"], AS_OF, unique_orders)
    found = {r.customer_id: r for r in revenue.collect()}
    expected = brute(tables["rows"], 1, {5})
    assert set(found) == set(expected)
    for key, rows in expected.items():
        row = found[key]
        assert row.total_orders == len(rows)
        assert row.total_revenue == row.lifetime_value_actual == sum(r[4] for r in rows)
        assert row.first_order_date == min(r[5] for r in rows)
        assert row.last_order_date == max(r[5] for r in rows)
        assert row.days_since_last_order == (AS_OF - row.last_order_date).days


def test_distinct_orders_where_ids_repeat(spark, tables):
    """Tables that skipped the uniqueness check are counted by distinct id."""
    twice = tables["orders"].unionByName(tables["orders"])
    once = gold.sales_by_product(tables["orders"], tables["products"])
    counted = gold.sales_by_product(twice, tables["products"])
    assert {r.product_id: r.total_orders for r in once.collect()} == {
        r.product_id: r.total_orders for r in counted.collect()
    }


def test_orders_are_combined_before_they_are_shuffled(tables):
    checked = tables["orders"].withColumn(UNIQUENESS, F.lit("PASS"))
    plan = plan_text(gold.sales_by_product(checked, tables["products"]))
    below = plan.split("Exchange hashpartitioning(product_id")[1]
    assert "partial_sum" in below and "order_id" not in plan.split("partial_sum")[0].split("Exchange")[-1]


def test_empty_inputs(spark, tables):
    none = tables["orders"].filter("false")
    revenue = gold.revenue_by_customer(none, tables["customers"], AS_OF)
    assert revenue.count() == 0
    assert gold.sales_by_product(none, tables["products"]).count() == 0
    assert gold.customer_segmentation(revenue).count() == 0
    assert dashboard.revenue_concentration(revenue).count() == 0
    row = reconcile.revenue_reconciliation(
        none, gold.sales_by_product(none, tables["products"]), revenue
    ).first()
    assert row.silver_pass_revenue == 0
    tiers = gold.value_tiers(none, tables["customers"])
    assert {r.revenue_segment for r in tiers.collect()} == {"no_purchase"}


def test_segmentation_adds_up(tables):
    revenue = gold.revenue_by_customer(tables["orders"], tables["customers"], AS_OF)
    rows = gold.customer_segmentation(revenue).collect()
    assert sum(r.customer_count for r in rows) == revenue.count()
    assert sum(r.pct_of_total_customers for r in rows) == pytest.approx(100, abs=0.05)
    check = reconcile.segment_total_check(gold.customer_segmentation(revenue), revenue).first()
    assert check.is_valid and check.segmented_customers == check.customers_with_orders


def test_reconciliation_names_what_failed_parents_lost(tables):
    sales = gold.sales_by_product(tables["orders"], tables["products"])
    revenue = gold.revenue_by_customer(tables["orders"], tables["customers"], AS_OF)
    row = reconcile.revenue_reconciliation(tables["orders"], sales, revenue).first()
    passing = [r for r in tables["rows"] if r[6] == "PASS"]
    assert row.silver_pass_revenue == sum(r[4] for r in passing)
    assert row.lost_to_failed_products == sum(r[4] for r in passing if r[2] in (4, None))
    assert row.lost_to_failed_customers == sum(r[4] for r in passing if r[1] in (5, None))


def test_weeks_across_the_year_end(spark):
    rows = [(1, 1, 1, 1, Decimal(1), date(2024, 12, 30), "PASS"),
            (2, 1, 1, 1, Decimal(2), date(2025, 1, 2), "PASS"),
            (3, 1, 1, 1, Decimal(4), date(2024, 1, 3), "PASS")]
    orders = make_orders(spark, rows)
    weekly = {r.week_start: r.order_count for r in gold.weekly_trend(orders).collect()}
    assert weekly == {date(2024, 12, 30): 2, date(2024, 1, 1): 1}
    daily = {r.order_day: (r.year, r.week) for r in gold.daily_trend(orders).collect()}
    assert daily[date(2024, 12, 30)] == (2024, 1) and daily[date(2025, 1, 2)] == (2025, 1)


def test_top_lists_break_ties_by_key(spark):
    sales = spark.createDataFrame(
        [(i, f"p{i}", "A" if i % 2 else "B", 1, 1, Decimal(100 - i // 2)) for i in range(30)],
        "product_id long, product_name string, category string, total_orders long, "
        "total_quantity long, total_revenue decimal(18,2)",
    )
    assert [r.product_name for r in dashboard.top_products(sales).collect()] == [
        f"p{i}" for i in range(10)
    ]
    filters = DashboardFilters(category="A", revenue_above=98.5)
    assert [r.product_name for r in dashboard.top_products(sales, filters).collect()] == ["p1", "p3"]
    assert "TakeOrderedAndProject" in plan_text(dashboard.top_products(sales))


def test_monthly_trend_filters(tables):
    filters = DashboardFilters(orders_from=date(2024, 3, 1), orders_to=date(2024, 5, 31))
    months = [r.month for r in dashboard.monthly_trend(tables["orders"], filters).collect()]
    assert months == [date(2024, 3, 1), date(2024, 4, 1), date(2024, 5, 1)]
    bound = dashboard.monthly_trend_sql(tables["orders"], date(2024, 3, 1), date(2024, 5, 31))
    assert [tuple(r) for r in bound.collect()] == [
        tuple(r) for r in dashboard.monthly_trend(tables["orders"], filters).collect()
    ]
    none = DashboardFilters(order_status="Cancelled")
    assert dashboard.monthly_trend(tables["orders"], none).count() == 0


def test_histogram_variants(tables):
    revenue = gold.revenue_by_customer(tables["orders"], tables["customers"], AS_OF)
    total = revenue.count()
    for histogram in (
        dashboard.revenue_histogram(revenue), dashboard.revenue_histogram_design(revenue),
    ):
        assert sum(r.customer_count for r in histogram.collect()) == total
    other = DashboardFilters(country="elsewhere")
    assert dashboard.revenue_histogram(revenue, other).count() == 0
    concentration = dashboard.revenue_concentration(revenue).collect()
    assert concentration[-1].cumulative_pct == pytest.approx(100.0)
    assert sum(r.pct_of_revenue for r in concentration) == pytest.approx(100.0, abs=0.05)


def _messy_parents(spark):
    customers = [(i, f"c{i}" if i % 5 else None, "S", "X", "PASS" if i % 4 else "FAIL: x") for i in range(12)]
    products = [(i, f"p{i}", "cat" if i % 3 else None, "PASS" if i % 6 else "FAIL: y") for i in range(9)]
    columns = "customer_id long, customer_name string, customer_segment string, country string, quality_check_result string"
    return (
        spark.createDataFrame(customers + customers[1:2] + [(2, "other", "S", "X", "PASS")], columns),
        spark.createDataFrame(
            products + products[1:2], "product_id long, product_name string, category string, quality_check_result string"
        ).withColumns({"price": F.lit(Decimal("2.00")), "cost": F.lit(Decimal("1.00"))}),
    )


def test_totals_in_one_pass_equal_the_gold_tables(spark):
    rows = [
        (i, i % 15 if i % 7 else None, i % 11, 1, Decimal(i) if i % 13 else None, DAY - timedelta(days=9 * i), "PASS" if i % 9 else "FAIL")
        for i in range(200)
    ]
    orders = make_orders(spark, rows)
    customers, products = _messy_parents(spark)
    sales, revenue = gold.sales_by_product(orders, products), gold.revenue_by_customer(orders, customers, DAY)
    totals = reconcile.gold_totals(orders, [reconcile.sold_products(products), reconcile.buying_customers(customers, DAY)])
    assert totals.count() <= 20
    wanted = reconcile.revenue_reconciliation(orders, sales, revenue)
    assert reconcile.reconciled_totals(totals).collect() == wanted.collect()
    assert reconcile.reconciled_totals(totals).dtypes == wanted.dtypes
    segmentation = gold.customer_segmentation(revenue)
    checked = {r.table_name: (r.row_count, r.null_key_rows) for r in reconcile.key_nulls_of_totals(totals).collect()}
    for name, frame, keys in (
        ("gold_sales_by_product", sales, ["product_id", "product_name", "category", "total_revenue"]),
        ("gold_revenue_by_customer", revenue, ["customer_id", "customer_name", "total_revenue"]),
        ("gold_customer_segmentation", segmentation, ["segment_type", "customer_count", "total_revenue"]),
    ):
        row = metrics.key_null_check(frame, name, keys).first()
        assert checked[name] == (row.row_count, row.null_key_rows), name
    assert sum(n for _, n in checked.values()) > 0
    alone = reconcile.gold_totals(orders, [reconcile.buying_customers(customers, DAY)])
    assert reconcile.segment_total_of(alone).collect() == reconcile.segment_total_check(segmentation, revenue).collect()


def test_totals_of_no_orders(spark):
    orders = make_orders(spark, [])
    customers, products = _messy_parents(spark)
    totals = reconcile.gold_totals(orders, [reconcile.sold_products(products), reconcile.buying_customers(customers, DAY)])
    assert tuple(reconcile.reconciled_totals(totals).first()) == (Decimal(0),) * 5
    assert {r.row_count for r in reconcile.key_nulls_of_totals(totals).collect()} <= {0}


def test_gold_checks_scan_the_orders_once(spark):
    for name in ("gold_reconciliation", "gold_key_null_check", "segment_total_check"):
        plan = plan_text(workload_queries.registered()[name](spark, SMALL_TABLES))
        assert plan.count("orders.parquet]") == 1, name
