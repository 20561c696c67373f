"""Every registered query against its SQL twin, and the published fixture totals."""

from __future__ import annotations

from decimal import Decimal

import pytest

import __spark_entry__ as entry
from tests.comparison import connect, duckdb_result, spark_result
from tests.conftest import SMALL_TABLES, plan_text
from workload import queries as workload_queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL_TABLES)


def test_every_query_has_a_twin():
    assert set(workload_queries.registered()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(workload_queries.registered()))
def test_query_equals_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SMALL_TABLES)
    types, rows = spark_result(df)
    other_types, other_rows = duckdb_result(duck, entry.oracle_sql()[name])
    assert types == other_types
    assert rows == other_rows
    assert rows, "a query without rows checks nothing"
    assert "Python" not in plan_text(df)


def test_entry(spark):
    assert entry.entry(spark).count() == 198


def test_published_fixture_totals(spark):
    passed = {r.table_name: (r.pass_rows, r.total_rows) for r in workload_queries.silver_pass_summary(spark, SMALL_TABLES).collect()}
    assert passed == {
        "silver_customers": (141, 150),
        "silver_products": (198, 200),
        "silver_orders": (1478, 1500),
    }
    row = workload_queries.gold_reconciliation(spark, SMALL_TABLES).first()
    assert row.silver_pass_revenue == Decimal("741486.10")
    assert row.product_revenue == Decimal("734993.30")
    assert row.customer_revenue == Decimal("706496.60")
