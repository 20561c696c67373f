"""The checks against hand-written frames and brute force, on every join path."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import fixed_values as fixed
from assayline.operators import checks
from assayline.operators.lookup import KeySet, SizeBound, mark_members
from assayline.plans.silver import flagged_tables
from assayline.specs import CUSTOMERS, ORDERS, PRODUCTS, ForeignKey
from tests.conftest import AS_OF, plan_text

NEVER_BROADCAST = SizeBound(rows=0)
ANY_PATH = pytest.mark.parametrize("bound", [SizeBound(), NEVER_BROADCAST], ids=["broadcast", "merge"])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_completeness_names_the_first_null_field(spark):
    df = spark.createDataFrame(
        [(1, 1), (None, 1), (1, None), (None, None)], "customer_id long, product_id long"
    )
    flagged = checks.flag_completeness(df, ORDERS.completeness)
    assert [r[checks.COMPLETENESS] for r in flagged.collect()] == [
        "PASS", "FAIL: NULL customer_id", "FAIL: NULL product_id", "FAIL: NULL customer_id",
    ]


def test_blank_is_complete_but_not_filled(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "email string")
    flagged = checks.flag_completeness(df, ["email"])
    assert [r[checks.COMPLETENESS] for r in flagged.collect()] == [
        "FAIL: NULL email", "PASS", "PASS", "PASS",
    ]
    failed = df.select(checks.unfilled_fields(["email"]).alias("f"))
    assert [r.f for r in failed.collect()] == ["email", "email", "email", ""]


def test_no_completeness_fields_pass(spark):
    flagged = checks.flag_completeness(spark.range(2), PRODUCTS.completeness)
    assert {r[checks.COMPLETENESS] for r in flagged.collect()} == {"PASS"}


@ANY_PATH
@pytest.mark.parametrize("nulls", [0, 1, 2])
def test_uniqueness_flags_every_row_of_a_key(spark, bound, nulls):
    values = [1, 2, 2, 3, 3, 3] + [None] * nulls
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k long, i int")
    flagged = checks.flag_uniqueness(df, ["k"], bound)
    counted = Counter(values)
    expected = [
        (v, i, "PASS" if counted[v] == 1 else "FAIL: DUPLICATE k") for i, v in enumerate(values)
    ]
    assert rows_of(flagged, "k", "i", checks.UNIQUENESS) == sorted(expected, key=repr)


@ANY_PATH
def test_uniqueness_of_a_composite_key_with_partial_nulls(spark, bound):
    pairs = [(1, "a"), (1, "b"), (1, "a"), (1, None), (1, None), (None, None)]
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "a long, b string, i int")
    flagged = checks.flag_uniqueness(df, ["a", "b"], bound)
    failed = {r.i for r in flagged.filter(F.col(checks.UNIQUENESS) != "PASS").collect()}
    assert failed == {0, 2, 3, 4}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=40))
def test_uniqueness_against_brute_force(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    flagged = checks.flag_uniqueness(df, ["k"])
    counted = Counter(keys)
    expected = sorted(
        [(k, "PASS" if counted[k] == 1 else "FAIL: DUPLICATE k") for k in keys], key=repr
    )
    assert rows_of(flagged, "k", checks.UNIQUENESS) == expected


@ANY_PATH
def test_keep_first_with_a_hot_key_and_exact_copies(spark, bound):
    """A third of the rows share one key, half of them exact copies of the first row."""
    generator = random.Random(7)
    rows = [(1, 0 if i % 2 else generator.randrange(1, 50)) for i in range(400)]
    rows += [(k, generator.randrange(50)) for k in range(2, 500)]
    rows += [(k, generator.randrange(50)) for k in range(2, 300)]
    generator.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, t int").repartition(7)
    flagged = checks.flag_keep_first(df, ["k"], ["t"], bound)
    firsts, expected = {}, Counter()
    for k, t in rows:
        firsts[k] = min(firsts.get(k, t), t)
    seen = set()
    for k, t in sorted(rows):
        kept = k not in seen and t == firsts[k]
        seen.add(k) if kept else None
        expected[(k, t, "PASS" if kept else "FAIL: DUPLICATE k")] += 1
    assert Counter(tuple(r) for r in flagged.select("k", "t", checks.UNIQUENESS).collect()) == expected


def test_type_flag_takes_the_first_broken_rule(spark):
    df = spark.createDataFrame(
        [("0", "x", "2099-01-01"), ("1", "x", "2099-01-01"), ("1", "5", "2099-01-01"),
         ("1", "5", "2024-01-01"), (None, None, None)],
        "quantity string, total_amount string, order_date string",
    )
    flagged = checks.flag_types(df, ORDERS.rules, AS_OF)
    assert [r[checks.TYPE_VALIDATION] for r in flagged.collect()] == [
        "FAIL: INVALID quantity - must be positive integer",
        "FAIL: INVALID total_amount - must be positive decimal",
        "FAIL: INVALID order_date - invalid or future date",
        "PASS",
        "PASS",
    ]


@ANY_PATH
def test_referential_flag_detail_and_parents_with_duplicates(spark, bound):
    orders = spark.createDataFrame(
        [(1, 1, 1), (2, 9, 1), (3, 1, 9), (4, 9, 9), (5, None, 9), (6, None, None)],
        "order_id long, customer_id long, product_id long",
    )
    customers = spark.createDataFrame([(1,), (1,), (None,)], "customer_id long")
    products = spark.createDataFrame([(1,), (1,)], "product_id long")
    parents = {"customers": customers, "products": products}
    flagged = checks.flag_referential(orders, ORDERS.foreign_keys, parents, bound, keep_markers=True)
    detail = checks.referential_detail(
        {"customer_id": "MISSING_CUSTOMER", "product_id": "MISSING_PRODUCT"}
    )
    assert rows_of(flagged, "order_id", checks.REFERENTIAL, detail.alias("d")) == [
        (1, "PASS", None),
        (2, "FAIL: ORPHAN customer_id", "MISSING_CUSTOMER"),
        (3, "FAIL: ORPHAN product_id", "MISSING_PRODUCT"),
        (4, "FAIL: ORPHAN customer_id", "BOTH"),
        (5, "FAIL: ORPHAN product_id", "MISSING_PRODUCT"),
        (6, "PASS", None),
    ]


def test_combine_and_codes(spark):
    flags = [
        ("PASS", "PASS", "PASS", "PASS"),
        ("FAIL: NULL email", "PASS", "PASS", "PASS"),
        ("FAIL: NULL email", "PASS", "PASS", "FAIL: ORPHAN product_id"),
    ]
    df = spark.createDataFrame(flags, list(fixed.CHECK_COLUMNS.values()))
    combined = checks.combine_flags(df)
    assert [r[fixed.VERDICT_COLUMN] for r in combined.collect()] == [
        "PASS", "FAIL: FAIL: NULL email", "FAIL: FAIL: NULL email, FAIL: ORPHAN product_id",
    ]
    codes = df.select(
        checks.composite_code(df).alias("c"),
        checks.first_failure_code(df).alias("f"),
        checks.failure_reasons(df).alias("r"),
    )
    assert [tuple(r) for r in codes.collect()] == [
        ("PASS", "PASS", None),
        ("FAIL_COMPLETENESS", "FAIL_COMPLETENESS", "completeness"),
        ("FAIL_MULTIPLE:COMPLETENESS,REFERENTIAL_INTEGRITY", "FAIL_COMPLETENESS",
         "completeness,referential_integrity"),
    ]


def test_combine_without_flags_passes(spark):
    assert checks.combine_flags(spark.range(1)).first()[fixed.VERDICT_COLUMN] == "PASS"
    df = spark.createDataFrame([("FAIL: NULL x",)], [checks.COMPLETENESS])
    assert checks.combine_flags(df).first()[fixed.VERDICT_COLUMN] == "FAIL: FAIL: NULL x"


def test_business_rules(spark):
    schema = (
        "quantity int, unit_price decimal(18,2), total_amount decimal(18,2), order_date date, "
        "order_status string"
    )
    d, day = Decimal, date(2024, 1, 1)
    df = spark.createDataFrame(
        [
            (2, d("1.50"), d("3.00"), day, "Completed"),
            (0, d("1.50"), d("0.00"), day, "refunded"),
            (1, d("-1.00"), d("-1.00"), date(2099, 1, 1), "PENDING"),
            (2, d("1.50"), d("3.01"), day, "cancelled"),
            (None, None, None, None, None),
        ],
        schema,
    )
    assert [r[fixed.BUSINESS_COLUMN] for r in checks.flag_business_rules(df, AS_OF).collect()] == [
        "PASS",
        "FAIL_BUSINESS_LOGIC:QUANTITY,STATUS",
        "FAIL_BUSINESS_LOGIC:PRICE,AMOUNT,ORDER_DATE",
        "FAIL_BUSINESS_LOGIC:AMOUNT_MISMATCH",
        "PASS",
    ]
    more = checks.flag_business_rules(df, AS_OF, (*fixed.ORDER_STATUSES, "Refunded"))
    assert more.collect()[1][fixed.BUSINESS_COLUMN] == "FAIL_BUSINESS_LOGIC:QUANTITY"


def test_standardize_by_name(spark):
    df = spark.createDataFrame([(" 7 ", " Ann ", "x", "bad")], "customer_id string, customer_name string, extra string, signup_date string")
    typed = checks.standardize(df, CUSTOMERS.schema)
    assert typed.columns == [*CUSTOMERS.schema.fieldNames(), "extra"]
    row = typed.first()
    assert (row.customer_id, row.customer_name, row.signup_date, row.email) == (7, "Ann", None, None)
    assert checks.standardize(df, CUSTOMERS.schema, trim_text=False).first().customer_name == " Ann "


def _bronze(spark, as_text=False):
    customers = spark.createDataFrame(
        [(1, "a@b.c"), (2, None), (2, "x@y.z"), (3, "bad")], "customer_id long, email string"
    ).select("*", F.lit(date(2020, 1, 1)).alias("signup_date"), F.lit("n").alias("customer_name"))
    products = spark.createDataFrame(
        [(1, 10.0, 5.0), (2, 0.0, None), (3, 10.0, 20.0)], "product_id long, price double, cost double"
    )
    orders = spark.createDataFrame(
        [(1, 1, 1), (2, 2, 2), (3, 9, 1), (3, 1, None), (5, 3, 3)],
        "order_id long, customer_id long, product_id long",
    ).select(
        "*", F.lit(1).alias("quantity"), F.lit(10.0).alias("total_amount"),
        F.lit(date(2024, 1, 1)).alias("order_date"),
    )
    frames = {"customers": customers, "products": products, "orders": orders}
    if as_text:
        frames = {
            n: df.select([F.col(c).cast("string").alias(c) for c in df.columns])
            for n, df in frames.items()
        }
    return frames


@ANY_PATH
@pytest.mark.parametrize("as_text", [False, True], ids=["typed", "text"])
def test_silver_tables(spark, bound, as_text):
    silver = flagged_tables(_bronze(spark, as_text), AS_OF, bound=bound)
    v = fixed.VERDICT_COLUMN
    assert rows_of(silver["customers"], "customer_id", v) == [
        (1, "PASS"),
        (2, "FAIL: FAIL: DUPLICATE customer_id"),
        (2, "FAIL: FAIL: NULL email, FAIL: DUPLICATE customer_id"),
        (3, "FAIL: FAIL: INVALID email - invalid email format"),
    ]
    assert rows_of(silver["products"], "product_id", v) == [
        (1, "PASS"),
        (2, "FAIL: FAIL: INVALID price - must be positive"),
        (3, "FAIL: FAIL: INVALID cost - must be positive and less than price"),
    ]
    assert rows_of(silver["orders"], "order_id", v) == [
        (1, "PASS"),
        (2, "PASS"),
        (3, "FAIL: FAIL: DUPLICATE order_id, FAIL: ORPHAN customer_id"),
        (3, "FAIL: FAIL: NULL product_id, FAIL: DUPLICATE order_id"),
        (5, "PASS"),
    ]
    for name, spec in (("customers", CUSTOMERS), ("products", PRODUCTS), ("orders", ORDERS)):
        declared = [f.dataType for f in spec.schema]
        assert [f.dataType for f in silver[name].schema][: len(declared)] == declared


def test_unreadable_text_is_invalid_and_not_null(spark):
    bronze = _bronze(spark, as_text=True)
    bronze["orders"] = bronze["orders"].withColumn("total_amount", F.lit("N/A"))
    flagged = flagged_tables(bronze, AS_OF)["orders"]
    assert {r[checks.TYPE_VALIDATION] for r in flagged.collect()} == {
        "FAIL: INVALID total_amount - must be positive decimal"
    }


def test_wide_rows_meet_no_shuffle_while_key_sets_are_small(spark):
    silver = flagged_tables(_bronze(spark), AS_OF)
    orders = plan_text(silver["orders"])
    assert "Exchange hashpartitioning" not in orders and "BroadcastHashJoin" in orders
    assert "Join" not in plan_text(silver["products"])  # no bad keys at all
    for df in silver.values():
        assert "Python" not in plan_text(df)


def test_large_key_sets_are_not_broadcast(spark):
    orders = plan_text(flagged_tables(_bronze(spark), AS_OF, bound=NEVER_BROADCAST)["orders"])
    assert "SortMergeJoin" in orders and "BroadcastHashJoin" not in orders
    assert "SortMergeJoin" in plan_text(
        mark_members(
            spark.range(10).toDF("k"),
            [KeySet("m", ("k",), spark.range(3).toDF("k"))],
            SizeBound(bytes=1),
        )
    )


def test_hot_orphan_key_on_the_merge_path_is_split(spark):
    """A third of the rows share one orphaned key; adaptive execution splits its partition."""
    rows = 300_000
    orders = spark.range(rows).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    )
    parents = {"customers": spark.range(rows).filter("id % 3 != 1").toDF("customer_id")}
    saved = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    for name, value in saved.items():
        spark.conf.set(name, value)
    try:
        foreign_keys = [ForeignKey("customer_id", "customers", "customer_id")]
        flagged = checks.flag_referential(orders, foreign_keys, parents, NEVER_BROADCAST)
        counted = {
            r[0]: r[1] for r in flagged.groupBy(checks.REFERENTIAL).agg(F.count("filler")).collect()
        }
        flagged.write.format("noop").mode("overwrite").save()
        run = flagged.select("filler", checks.REFERENTIAL)
        run.collect()
        assert "skew" in run._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in saved:
            spark.conf.unset(name)
    assert counted == {"FAIL: ORPHAN customer_id": 200_000, "PASS": 100_000}


def ranked_partitions(df):
    """Shuffle keys of the exchanges that feed the windows of a plan."""
    return [line for line in plan_text(df).split("\n") if "Exchange hashpartitioning" in line]


@ANY_PATH
def test_keep_first_reads_rows_once_and_ranks_none_without_copies(spark, tmp_path, bound):
    hot = spark.range(0, 3000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id % 700) AS k", "id AS t")
    hot.write.parquet(f"{tmp_path}/hot")
    df = spark.read.parquet(f"{tmp_path}/hot")
    flagged = checks.flag_keep_first(df, ["k"], ["t"], bound)
    plan = plan_text(flagged)
    assert plan.count(f"[file:{tmp_path}/hot") == 1 and "Window" not in plan
    kept = flagged.filter(F.col(checks.UNIQUENESS) == "PASS")
    assert sorted(map(tuple, kept.select("k", "t").collect())) == sorted(
        map(tuple, df.groupBy("k").agg(F.min("t")).collect())
    )
    none = checks.flag_keep_first(df.select("t"), ["t"], ["t"], bound)
    assert {r[checks.UNIQUENESS] for r in none.collect()} == {"PASS"} and "Join" not in plan_text(none)


@ANY_PATH
def test_keep_first_of_null_keys_and_null_order(spark, bound):
    rows = [(None, None, "a"), (None, None, "b"), (None, 2, "c"), (1, None, "d"), (1, 1, "e"), (2, 3, "f")]
    df = spark.createDataFrame(rows, "k long, t long, x string")
    flagged = checks.flag_keep_first(df, ["k"], ["t"], bound).collect()
    passed = [r.x for r in flagged if r[checks.UNIQUENESS] == "PASS"]
    assert len(flagged) == 6 and len(passed) == 3 and {"d", "f"} < set(passed) and {"a", "b"} & set(passed)


@ANY_PATH
def test_keep_first_deals_a_hot_key_out_before_ranking(spark, bound):
    """Only copies of a first row are ranked; here a third of the rows are copies of one row."""
    df = spark.range(0, 3000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id % 700) AS k", "IF(id % 3 = 0, 0, id) AS t")
    flagged = checks.flag_keep_first(df, ["k"], ["t"], bound)
    keys = ranked_partitions(flagged)
    assert any("_salt" in line for line in keys) and any("_group" in line for line in keys)
    kept = flagged.filter(F.col(checks.UNIQUENESS) == "PASS")
    assert kept.count() == df.select("k").distinct().count()


def test_values_that_do_not_fit_fail_by_name(spark):
    landed = ["3.0", "3", "NaN", "Infinity", "1e20", "10d", "12.345", "abc", "N/A", "0.004", "-7", None]
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("m", T.DecimalType(18, 2))])
    df = spark.createDataFrame([(v, v) for v in landed], "n string, m string")
    flagged = df.select("n", "m", F.monotonically_increasing_id().alias("i"), F.lit("PASS").alias(checks.TYPE_VALIDATION))
    flagged = checks.flag_unfitting(flagged, schema)
    rows = checks.standardize(flagged.withColumn("text", F.col("n")), schema).collect()
    numbers = {r.text: (r.n, None if r.m is None else str(r.m), r[checks.TYPE_VALIDATION] == "PASS") for r in rows}
    assert numbers["3.0"] == (3, "3.00", True) and numbers["3"] == (3, "3.00", True)
    assert numbers["-7"] == (-7, "-7.00", True) and numbers[None] == (None, None, True)
    for lost in ("NaN", "Infinity", "10d", "12.345", "abc", "N/A", "0.004"):
        assert not numbers[lost][2], lost
        assert numbers[lost][1] is None or lost == "1e20"
    assert numbers["1e20"][0] is None and not numbers["1e20"][2]
