from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.operators import checks, metrics
from assayline.operators.lookup import Lookup, key_counts
from assayline.plans import dimensions
from assayline.plans.silver import flagged_tables, marked_tables
from assayline.specs import CUSTOMERS, ORDERS, TABLES
from tests.conftest import AS_OF
from tests.test_checks import _bronze

FLAGS = list(fixed.CHECK_COLUMNS.values())


def test_report_of_no_rows_and_of_all_failing(spark):
    empty = checks.combine_flags(spark.createDataFrame([], ", ".join(f"{c} string" for c in FLAGS)))
    rows = metrics.check_report(empty, "t").collect()
    assert [r.check_type for r in rows] == [*fixed.CHECK_COLUMNS, "overall"]
    assert {(r.total_rows, r.passed, r.failed, r.pass_rate) for r in rows} == {(0, 0, 0, 1.0)}

    failing = checks.combine_flags(spark.createDataFrame([("F", "F", "F", "F")] * 3, FLAGS))
    rows = metrics.check_report(failing, "t").collect()
    assert {(r.total_rows, r.passed, r.failed, r.pass_rate) for r in rows} == {(3, 0, 3, 0.0)}


def test_report_skips_absent_flags(spark):
    df = spark.createDataFrame([("PASS",), ("FAIL: x",), ("PASS",)], [checks.UNIQUENESS])
    assert [tuple(r) for r in metrics.check_report(df, "t").collect()] == [
        ("t", "uniqueness", 3, 2, 1, 0.6667)
    ]


def test_report_columns_are_never_null(spark):
    silver = flagged_tables(_bronze(spark), AS_OF)
    report = metrics.quality_report({f"silver_{n}": df for n, df in silver.items()})
    assert report.count() == 15
    assert all(not field.nullable for field in report.schema)
    assert all(r.passed + r.failed == r.total_rows for r in report.collect())


def test_metrics_agree_with_row_flags(spark):
    bronze = _bronze(spark)
    silver = flagged_tables(bronze, AS_OF)
    for spec in TABLES:
        unique = metrics.uniqueness_metric(bronze[spec.name], "t", spec.primary_key).first()
        flagged = silver[spec.name].filter(F.col(checks.UNIQUENESS) != "PASS").count()
        assert (unique.total_rows, unique.duplicate_rows) == (bronze[spec.name].count(), flagged)
    referential = {
        r.check_name: r
        for r in metrics.referential_metrics(bronze["orders"], ORDERS.foreign_keys, bronze).collect()
    }
    assert referential["customer_id referential"].orphan_rows == 1
    assert referential["customer_id referential"].total_rows == 5
    assert referential["product_id referential"].orphan_rows == 0
    assert referential["product_id referential"].pass_rate == 100.0
    typed = {
        r.field_name: (r.evaluated_rows, r.invalid_rows)
        for r in metrics.rule_metrics(bronze["products"], "p", TABLES[1].rules, AS_OF).collect()
    }
    assert typed == {"price": (3, 1), "cost": (2, 1)}


def test_metrics_of_no_rows(spark):
    empty = spark.createDataFrame([], "customer_id long, email string")
    assert metrics.uniqueness_metric(empty, "t", "customer_id").first().pass_rate == 100.0
    row = metrics.completeness_metrics(empty, "t", ["email"]).first()
    assert (row.total_rows, row.null_count, row.pass_rate) == (0, 0, 100.0)
    fk = ORDERS.foreign_keys[0]
    assert metrics.orphan_counts(empty, fk, empty).first().total_rows == 0


def test_extended_report(spark):
    marked = marked_tables(_bronze(spark), AS_OF)["customers"]
    rows = metrics.extended_report(
        marked.withColumn("country", F.lit("x")), CUSTOMERS, "r1", F.lit(None).cast("timestamp")
    ).collect()
    assert [(r.check_name, r.column_name, r.passed) for r in rows] == [
        ("completeness", "email", 3),
        ("completeness", "all_required", 3),
        ("uniqueness", "customer_id", 2),
        ("type_validation", "all", 3),
        ("overall_pass", None, 1),
    ]


def test_alerts(spark):
    report = spark.createDataFrame(
        [
            ("uniqueness", 1000, 998, 0.998),
            ("completeness", 1000, 992, 0.992),
            ("completeness", 100, 99, 0.99),
            ("completeness", 100_000, 98_996, 0.99),  # rounds up to the limit that it misses
            ("overall", 2, 1, 0.5),
            ("overall", 0, 0, 1.0),
        ],
        "check_type string, total_rows long, passed long, pass_rate double",
    )
    assert [tuple(r)[4:] for r in metrics.with_alerts(report).collect()] == [
        ("normal", True), ("warning", False), ("warning", False), ("critical", True),
        ("critical", False), ("normal", False),
    ]


def _scans(df, path) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"[file:{path}")


def test_keys_of_a_table_come_from_one_scan(spark, tmp_path):
    bronze = {}
    for name, df in _bronze(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
        bronze[name] = spark.read.parquet(f"{tmp_path}/{name}")
    assert _scans(metrics.referential_metrics(bronze["orders"], ORDERS.foreign_keys, bronze), f"{tmp_path}/orders") == 1
    inventory = metrics.defect_inventory(bronze, TABLES)
    assert _scans(inventory, f"{tmp_path}/orders") == 2
    found = {(r.table_name, r.defect): r.row_count for r in inventory.collect()}
    for spec in TABLES:
        unique = metrics.uniqueness_metric(bronze[spec.name], "t", spec.primary_key).first()
        assert found[spec.bronze, f"DUPLICATE {spec.primary_key}"] == unique.duplicate_rows
        for fk in spec.foreign_keys:
            alone = metrics.orphan_counts(bronze[spec.name], fk, bronze[fk.parent]).first()
            assert found[spec.bronze, f"ORPHAN {fk.column}"] == alone.orphan_rows


def test_keys_of_no_rows(spark):
    empty = {s.name: spark.createDataFrame([], s.schema) for s in TABLES}
    rows = metrics.referential_metrics(empty["orders"], ORDERS.foreign_keys, empty).collect()
    assert [(r.total_rows, r.orphan_rows, r.pass_rate) for r in rows] == [(0, 0, 100.0)] * len(ORDERS.foreign_keys)
    assert {r.row_count for r in metrics.defect_inventory(empty, TABLES).collect()} == {0}


def test_key_null_check_and_missing_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    row = metrics.key_null_check(df, "t", ["a", "b"]).first()
    assert (row.row_count, row.null_key_rows) == (3, 2)
    assert metrics.missing_columns(df, ["a", "c"]) == ["c"]


def test_validation_finds_lost_rows_and_wrong_counts(spark):
    verdict = fixed.VERDICT_COLUMN
    silver = spark.createDataFrame([("PASS",), ("FAIL: x",)], [verdict])
    expected = spark.createDataFrame([("a", 1), ("b", 2)], "table_name string, expected_failed long")
    rows = metrics.silver_validation(
        {"a": spark.range(2), "b": spark.range(2), "c": spark.range(3)},
        {"a": silver, "b": silver, "c": silver},
        expected,
    ).collect()
    assert {r.table_name: r.is_valid for r in rows} == {"a": True, "b": False, "c": False}


@pytest.mark.parametrize("reason", ["DUPLICATE order_id", "ORPHAN customer_id"])
def test_rows_with_a_reason_among_others(spark, reason):
    orders = flagged_tables(_bronze(spark), AS_OF)["orders"]
    assert checks.failing_with(orders, reason).count() == {"D": 2, "O": 1}[reason[0]]
    assert checks.failing(orders).count() + checks.passing(orders).count() == 5


def _text_tables(spark):
    customers = [("1", "a"), (" 1", "b"), ("1.0", "c"), ("2", "d"), ("x", "e"), ("y", "f"), (None, "g")]
    orders = [("1", "1.0", "5"), ("1.0", " 2", "5.0"), ("2", "3", "6"), (" 3", "x", "7"), ("4", None, " 5")]
    return {
        "customers": spark.createDataFrame(customers, "customer_id string, email string"),
        "products": spark.createDataFrame([("5",), ("7.0",)], "product_id string"),
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string, product_id string"),
    }


def test_all_views_compare_keys_in_their_declared_types(spark):
    bronze = _text_tables(spark)
    silver = flagged_tables(bronze, AS_OF)
    flagged, unique = dimensions.uniqueness(bronze)
    wanted = {"customers": 6, "products": 0, "orders": 2}  # 1 three times and three keys that are none
    for name, rows in wanted.items():
        assert silver[name].filter(F.col(checks.UNIQUENESS) != "PASS").count() == rows
        assert flagged[name].columns == [*bronze[name].columns, checks.UNIQUENESS]
        assert flagged[name].filter(F.col(checks.UNIQUENESS) != "PASS").count() == rows
    assert {r.table_name: r.duplicate_rows for r in unique.collect()} == {f"bronze_{n}": k for n, k in wanted.items()}
    landed = sorted(r.order_id for r in flagged["orders"].filter(F.col(checks.UNIQUENESS) != "PASS").collect())
    assert landed == ["1", "1.0"]

    flagged, orphans = dimensions.referential_integrity(bronze)
    expected = [("1", "PASS"), ("1.0", "PASS"), ("2", "FAIL: ORPHAN customer_id"), (" 3", "PASS"), ("4", "PASS")]
    assert [(r.order_id, r[checks.REFERENTIAL]) for r in flagged["orders"].collect()] == expected
    assert sorted(r[checks.REFERENTIAL] for r in silver["orders"].collect()) == sorted(f for _, f in expected)
    assert {r.check_name: r.orphan_rows for r in orphans.collect()} == {
        "customer_id referential": 1, "product_id referential": 1,
    }
    inventory = {r.defect: r.row_count for r in metrics.defect_inventory(bronze, TABLES).collect()}
    assert inventory["DUPLICATE customer_id"] == 6 and inventory["DUPLICATE order_id"] == 2
    assert inventory["ORPHAN customer_id"] == 1 and inventory["ORPHAN product_id"] == 1


def test_keys_of_several_types_are_counted_apart(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b")], "n long, s string")
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    counted = key_counts(child, [Lookup("n"), Lookup("s", parent, "k")]).collect()
    assert sorted(map(tuple, counted), key=repr) == sorted(
        [(0, 2, False, True), (0, 1, False, False), (1, 1, False, True), (1, 2, True, True)], key=repr
    )
