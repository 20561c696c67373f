"""Each rule and classification on hand-written edge rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import fixed_values as fixed
from assayline.functions import classify, rules
from tests.conftest import AS_OF


def evaluate(spark, schema, rows, column):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [row[0] for row in df.select(column).collect()]


def broken(spark, kind, values, rule):
    return evaluate(spark, f"v {kind}", values, rules.breaks("v", rule("v")))


def test_email(spark):
    values = ["a@b.c", "a@b", "a b@c.d", None, "", "a@@b.c", "x@y.z.w"]
    assert broken(spark, "string", values, rules.valid_email) == [
        False, True, True, False, True, True, False,
    ]


def test_past_date_as_text_and_as_date(spark):
    def rule(field):
        return rules.date_not_after(field, AS_OF)

    values = ["2024-06-29", "2024-06-30", "2024-07-01", "2024-13-01", "2024-02-29", "2023-02-29", None, "x"]
    assert broken(spark, "string", values, rule) == [
        False, False, True, True, False, True, False, True,
    ]
    days = [date(2024, 6, 30), date(2024, 7, 1), None]
    assert broken(spark, "date", days, rule) == [False, True, False]


LANDED_DAYS = {
    "2024-06-29": True, " 2024-06-29 ": True, "2024": False, "2024-05": False, "2024-2-3": False,
    "2024-02-03 junk": False, "2024-02-03T99": False, "2024-02-03 00:00:00": False, "2024-02-30": False,
    "20240203": False, "+2024-02-03": False, "": False, "today": False, None: False,
}


def test_text_is_a_day_only_as_a_day_is_printed(spark):
    df = spark.createDataFrame([(v,) for v in LANDED_DAYS], "v string")
    day = rules.parsed(F.col("v"), T.StringType(), T.DateType())
    found = {r.v: (r.a, r.b) for r in df.select("v", rules.as_date("v").alias("a"), day.alias("b")).collect()}
    for text, fits in LANDED_DAYS.items():
        expected = date.fromisoformat(text.strip()) if fits else None
        assert found[text] == (expected, expected), text


def test_text_of_a_time_or_a_truth_value(spark):
    times = {
        "2024-02-03 10:00:00": True, "2024-02-03T10:00:00": True, "2024-02-03 10:00:00.500": True,
        "2024-02-03 10:00:00.000": True, "2024-02-03": False, "2024-02-03 10": False, "2024-02-03 10:00:00Z": False,
        "2024-02-03 25:00:00": False, "x": False,
    }
    df = spark.createDataFrame([(v,) for v in times], "v string")
    for kind in (T.TimestampType(), T.TimestampNTZType()):
        rows = df.select("v", rules.parsed(F.col("v"), T.StringType(), kind).alias("t")).collect()
        assert {r.v: r.t is not None for r in rows} == times
    truth = spark.createDataFrame([("true",), ("FALSE",), ("t",), ("1",), ("yes",)], "v string")
    rows = truth.select(rules.parsed(F.col("v"), T.StringType(), T.BooleanType()).alias("b")).collect()
    assert [r.b for r in rows] == [True, False, None, None, None]


def test_typed_values_that_another_type_cannot_keep(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1.0D, 2.50BD, TIMESTAMP '2024-02-03 00:00:00'), "
        "(1.5D, 2.505BD, TIMESTAMP '2024-02-03 01:00:00'), (1e20D, NULL, NULL), (double('NaN'), 1BD, NULL) AS t(d, m, s)"
    )
    kinds = {f.name: f.dataType for f in df.schema}
    cases = {"d": T.LongType(), "m": T.DecimalType(18, 2), "s": T.DateType()}
    rows = df.select(*[rules.parsed(F.col(c), kinds[c], kind).alias(c) for c, kind in cases.items()]).collect()
    assert [r.d for r in rows] == [1, None, None, None]
    assert [None if r.m is None else str(r.m) for r in rows] == ["2.50", None, None, "1.00"]
    assert [r.s for r in rows] == [date(2024, 2, 3), None, None, None]


def test_positive_integer_text(spark):
    values = ["1", "0", "-1", "3.7", "5.0", " 7 ", "N/A", "2147483647", "2147483648", "1e3", "NaN", "", None]
    assert broken(spark, "string", values, rules.positive_integer) == [
        False, True, True, True, False, False, True, False, True, True, True, True, False,
    ]


def test_positive_integer_numeric(spark):
    assert broken(spark, "double", [1.0, 3.7, 3e12, 0.0, None], rules.positive_integer) == [
        False, True, False, True, False,
    ]
    assert broken(spark, "bigint", [5, -5, 3_000_000_000], rules.positive_integer) == [
        False, True, False,
    ]


def test_numbers(spark):
    values = ["0.01", "0", "-0.01", "N/A", None, "1e3"]
    assert broken(spark, "string", values, rules.positive_number) == [
        False, True, True, True, False, False,
    ]
    assert broken(spark, "string", values, rules.non_negative_number) == [
        False, False, True, True, False, False,
    ]
    assert broken(spark, "string", values, rules.numeric) == [False, False, False, True, False, False]
    assert broken(spark, "string", ["0", "2", "2.5", "-1"], rules.non_negative_integer) == [
        False, False, True, True,
    ]


def test_cost_against_price(spark):
    rows = [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (None, 2.0), (1.0, None), (0.0, 2.0)]
    column = rules.breaks("cost", rules.cost_below_price("cost", "price"))
    assert evaluate(spark, "cost double, price double", rows, column) == [
        False, True, True, False, True, True,
    ]


def test_filled(spark):
    assert evaluate(spark, "v string", [None, "", "  ", "x"], rules.filled("v")) == [
        False, False, False, True,
    ]


@pytest.mark.parametrize(
    ("days", "revenue", "orders", "segment"),
    [
        (181, 99_999, 30, "Inactive"),
        (180, 99_999, 30, "High-Value"),
        (1, 10_000, 20, "Repeat"),
        (1, 10_001, 2, "High-Value"),
        (1, 5, 21, "High-Value"),
        (1, 5, 1, "One-Time"),
        (1, 5, 2, "Regular"),
        (1, 5, 4, "Regular"),
        (1, 5, 5, "Repeat"),
    ],
)
def test_segments(spark, days, revenue, orders, segment):
    schema = "days_since_last_order int, total_revenue int, total_orders int"
    assert evaluate(spark, schema, [(days, revenue, orders)], classify.customer_segment()) == [segment]


def test_buckets_and_their_order(spark):
    values = [-5.0, 99.99, 100.0, 500.0, 1000.0, 5000.0, 10_000.0, None]
    label = classify.bucket_label(F.col("v"), fixed.REVENUE_BUCKETS, fixed.LAST_REVENUE_BUCKET)
    order = classify.bucket_order(label, fixed.REVENUE_BUCKETS, fixed.LAST_REVENUE_BUCKET)
    assert evaluate(spark, "v double", values, label) == [
        "0-100", "0-100", "100-500", "500-1000", "1000-5000", "5000-10000", "10000+", "10000+",
    ]
    assert evaluate(spark, "v double", values, order) == [1, 1, 2, 3, 4, 5, 6, 6]


def test_value_tiers(spark):
    rows = [(0.0, 0), (0.0, 1), (499.99, 1), (500.0, 1), (4999.99, 1), (5000.0, 1)]
    tier = classify.value_tier(F.col("r"), F.col("n"))
    assert evaluate(spark, "r double, n int", rows, tier) == [
        "no_purchase", "low_value", "low_value", "medium_value", "medium_value", "high_value",
    ]
    other = classify.value_tier(F.col("r"), F.col("n"), ((1000, "high_value"), (100, "medium_value")))
    assert evaluate(spark, "r double, n int", [(999.0, 1), (1000.0, 1), (99.0, 1)], other) == [
        "medium_value", "high_value", "low_value",
    ]


def test_alert_levels(spark):
    assert evaluate(spark, "v double", [1.0, 0.995, 0.9949, 0.99, 0.9899], classify.alert_level(F.col("v"))) == [
        "normal", "normal", "warning", "warning", "critical",
    ]


def test_rates_of_no_rows(spark):
    assert evaluate(spark, "a bigint, b bigint", [(0, 0), (1, 3)], classify.pass_rate(F.col("a"), F.col("b"))) == [
        1.0, 0.3333,
    ]
    assert evaluate(spark, "a bigint, b bigint", [(0, 0), (1, 4)], classify.pass_percent(F.col("a"), F.col("b"))) == [
        100.0, 75.0,
    ]
