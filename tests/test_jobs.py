"""Generated extracts through all layers, and the edge cases of landing files."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assayline import fixed_values as fixed
from assayline.operators import checks, metrics
from assayline.plans import dimensions, gold, jobs, reconcile, silver
from assayline.samples import synthetic
from assayline.samples.defects import defect_summary, inject_defects
from assayline.sources import files, tables
from assayline.specs import CUSTOMERS, ORDERS, PRODUCTS, TABLES

DAY = date(2025, 1, 15)
VERDICT = fixed.VERDICT_COLUMN


@pytest.fixture(scope="module")
def extracts(spark):
    clean = synthetic.synthetic_tables(spark)
    return {
        "customers": inject_defects(clean["customers"], synthetic.CUSTOMER_DEFECTS),
        "products": clean["products"],
        "orders": inject_defects(clean["orders"], synthetic.ORDER_DEFECTS),
    }


@pytest.fixture(scope="module")
def landing(spark, extracts, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for spec in TABLES:
        files.write_csv(extracts[spec.name], f"{folder}/{spec.source_file}")
    return str(folder)


@pytest.fixture(scope="module")
def layers(spark, landing):
    spark.sql("CREATE DATABASE IF NOT EXISTS layers_test")
    spark.catalog.setCurrentDatabase("layers_test")
    bronze = jobs.run_bronze(spark, landing)
    flagged_layer = jobs.run_silver(spark, DAY, run_id="first")
    outcomes = jobs.run_gold(spark, DAY)
    yield {"bronze": bronze, "silver": flagged_layer, "gold": outcomes}
    for name in tables.DEFINITIONS:
        tables.drop_table(spark, name)
    spark.catalog.setCurrentDatabase("default")


def flagged(frame, column, text):
    return frame.filter(F.col(column) == text).count()


def test_generated_rows_are_deterministic_and_consistent(spark, extracts):
    again = synthetic.synthetic_tables(spark)
    assert again["orders"].exceptAll(synthetic.synthetic_tables(spark)["orders"]).count() == 0
    assert again["orders"].exceptAll(synthetic.synthetic_tables(spark, seed=1)["orders"]).count() > 0
    broken = again["orders"].join(again["products"], "product_id").filter(
        "unit_price <> price OR total_amount <> quantity * unit_price "
        "OR (order_status = 'Completed') <> (payment_date IS NOT NULL) "
        "OR payment_date NOT BETWEEN order_date AND order_date + INTERVAL 7 DAYS"
    )
    assert broken.count() == 0
    shares = dict(again["orders"].groupBy("order_status").count().collect())
    assert shares["Completed"] == pytest.approx(70_000, rel=0.02)
    margins = again["products"].agg(F.min(F.col("cost") / F.col("price")), F.max(F.col("cost") / F.col("price"))).first()
    assert margins[0] >= 0.29 and margins[1] <= 0.71


def test_injected_defects_are_found_by_the_checks(extracts):
    customers = checks.flag_completeness(extracts["customers"], CUSTOMERS.completeness)
    assert flagged(customers, checks.COMPLETENESS, "FAIL: NULL email") == 50
    customers = checks.flag_uniqueness(extracts["customers"], ["customer_id"])
    assert flagged(customers, checks.UNIQUENESS, "FAIL: DUPLICATE customer_id") == 20
    orders = checks.flag_completeness(extracts["orders"], ORDERS.completeness)
    assert flagged(orders, checks.COMPLETENESS, "FAIL: NULL customer_id") == 100
    assert flagged(orders, checks.COMPLETENESS, "FAIL: NULL product_id") == 200
    orders = checks.flag_uniqueness(extracts["orders"], ["order_id"])
    assert flagged(orders, checks.UNIQUENESS, "FAIL: DUPLICATE order_id") == 20


def test_orphans_include_those_of_overwritten_customers(extracts):
    orders = checks.flag_referential(extracts["orders"], ORDERS.foreign_keys, extracts)
    orphans = flagged(orders, checks.REFERENTIAL, "FAIL: ORPHAN customer_id")
    lost = extracts["orders"].filter("customer_id <= 10000 AND customer_id % 1000 = 7").count()
    assert orphans == 50 + lost
    assert flagged(orders, checks.REFERENTIAL, "FAIL: ORPHAN product_id") == 30


def test_defect_summary(spark):
    clean = synthetic.synthetic_tables(spark)["orders"]
    found = {
        r.defect: r.row_count
        for r in defect_summary(clean, "orders", synthetic.ORDER_DEFECTS).collect()
    }
    assert found == {
        "NULL customer_id": 100, "orphan customer_id": 50, "NULL product_id": 200,
        "orphan product_id": 30, "duplicate order_id": 10,
    }


def test_bronze_lands_everything(spark, layers, landing):
    assert [(o.table_name, o.success, o.row_count) for o in layers["bronze"]] == [
        ("bronze_customers", True, 10_000),
        ("bronze_products", True, 500),
        ("bronze_orders", True, 100_000),
    ]
    orders = spark.table("bronze_orders")
    assert orders.columns == [*ORDERS.schema.fieldNames(), "ingestion_timestamp", "source_file"]
    assert orders.select("source_file").distinct().collect()[0][0] == f"{landing}/orders.csv"
    assert orders.filter("ingestion_timestamp IS NULL").count() == 0


def test_pass_rate_over_all_tables(layers):
    frames = {n: df for n, df in layers["silver"].items() if n != jobs.QUALITY_REPORT}
    row = metrics.overall_pass_rate(frames).first()
    assert row.total_rows == 110_500
    assert row.pass_rate_pct == pytest.approx(99.3, abs=0.5)


def test_silver_types_and_report(spark, layers):
    orders = spark.table("silver_orders")
    assert [f.dataType for f in orders.schema][:9] == [f.dataType for f in ORDERS.schema]
    report = spark.table(jobs.QUALITY_REPORT)
    assert report.count() == 15
    comments = {f.name: f.metadata.get("comment") for f in report.schema}
    assert comments["pass_rate"]
    row = report.filter("table_name = 'silver_customers' AND check_type = 'completeness'").first()
    assert (row.total_rows, row.passed, row.failed, row.pass_rate) == (10_000, 9_950, 50, 0.995)


def test_gold_holds_passing_rows_only(spark, layers):
    assert all(o.success for o in layers["gold"].values()), layers["gold"]
    row = reconcile.revenue_reconciliation(
        spark.table("silver_orders"),
        spark.table("gold_sales_by_product"),
        spark.table("gold_revenue_by_customer"),
    ).first()
    assert row.lost_to_failed_products == 0
    assert 0 < row.lost_to_failed_customers < row.silver_pass_revenue / 100
    failed = spark.table("silver_customers").filter(F.col(VERDICT) != "PASS")
    lost = checks.passing(spark.table("silver_orders")).join(failed, "customer_id", "left_semi")
    assert lost.agg(F.sum("total_amount")).first()[0] == row.lost_to_failed_customers
    customers = spark.table("gold_revenue_by_customer").count()
    segments = spark.table("gold_customer_segmentation").agg(F.sum("customer_count")).first()[0]
    assert segments == customers
    assert spark.table("gold_sales_by_product").count() <= 500


def test_metrics_per_column_are_appended_by_run(spark, layers):
    jobs.run_silver(spark, DAY, run_id="second")
    rows = spark.table(jobs.QUALITY_METRICS)
    assert dict(rows.groupBy("run_id").count().collect()) == {"first": 17, "second": 17}
    orphans = rows.filter("run_id = 'first' AND check_name = 'referential_integrity'").collect()
    assert {r.column_name: r.failed for r in orphans}["product_id"] == 30


def test_quarantine_views(spark, layers):
    names = silver.quarantine_views({"orders": spark.table("silver_orders")})
    assert names == ["silver_orders_quarantine"]
    failed = spark.table("silver_orders").filter(F.col(VERDICT) != "PASS").count()
    assert spark.sql("SELECT count(*) FROM silver_orders_quarantine").first()[0] == failed


def test_each_dimension_alone(extracts):
    flagged_frames, measured = dimensions.completeness(extracts)
    assert set(flagged_frames) == {"customers", "orders"}
    assert {r.field_name: r.null_count for r in measured.collect()} == {
        "email": 50, "customer_id": 100, "product_id": 200,
    }
    flagged_frames, measured = dimensions.uniqueness(extracts)
    assert {r.field_name: r.duplicate_rows for r in measured.collect()} == {
        "customer_id": 20, "order_id": 20, "product_id": 0,
    }
    flagged_frames, measured = dimensions.type_validation(extracts, DAY)
    assert {r.invalid_rows for r in measured.collect()} == {0}
    flagged_frames, measured = dimensions.referential_integrity(extracts)
    by_check = {r.check_name: r.orphan_rows for r in measured.collect()}
    for fk in ORDERS.foreign_keys:
        text = fixed.ORPHAN_FLAG.format(field=fk.column)
        assert flagged(flagged_frames["orders"], checks.REFERENTIAL, text) == by_check[f"{fk.column} referential"]


def test_runs_are_repeatable(spark, layers):
    before = spark.table("gold_sales_by_product").collect()
    outcomes = jobs.run_gold(spark, DAY)
    assert all(o.success for o in outcomes.values())
    assert sorted(map(tuple, before)) == sorted(map(tuple, spark.table("gold_sales_by_product").collect()))


def test_inferred_and_text_landing_give_the_same_verdicts(spark, landing):
    verdicts = []
    for infer in (True, False):
        frames = {
            spec.name: files.read_csv(spark, f"{landing}/{spec.source_file}", infer=infer)
            for spec in TABLES
        }
        flagged_frames = silver.flagged_tables(frames, DAY)
        verdicts.append({n: df.drop("_x") for n, df in flagged_frames.items()})
    for spec in TABLES:
        left, right = (v[spec.name] for v in verdicts)
        assert left.schema == right.schema
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def _contents(spark, names):
    return {name: sorted(map(repr, spark.table(name).collect())) for name in names}


def test_a_failed_row_check_leaves_the_former_tables(spark, layers, monkeypatch):
    names = [spec.silver for spec in TABLES]
    before = _contents(spark, names)
    whole = jobs.without_markers

    def loses_orders(marked, bronze):
        return {n: df.filter("order_id > 10") if n == "orders" else df for n, df in whole(marked, bronze).items()}

    monkeypatch.setattr(jobs, "without_markers", loses_orders)
    with pytest.raises(ValueError, match="silver_orders would hold"):
        jobs.run_silver(spark, DAY)
    assert _contents(spark, names) == before
    assert not any(tables.staging_name(n) in {t.name for t in spark.catalog.listTables()} for n in names)


def test_a_failed_gold_check_leaves_the_former_table(spark, layers):
    name = "gold_sales_by_product"
    before = _contents(spark, [name])
    nulls = jobs.GoldJob(name, ("total_revenue",), lambda s, _: s.table(name).withColumn("total_revenue", F.lit(None)))
    outcome = jobs.run_gold(spark, DAY, [nulls])[name]
    assert not outcome.success and "NULL key column" in outcome.error_message
    assert _contents(spark, [name]) == before
    assert not spark.catalog.tableExists(tables.staging_name(name))


def test_promotion_gate(spark, layers):
    report = spark.table(jobs.QUALITY_REPORT)
    jobs.promotion_gate(report)
    with pytest.raises(ValueError, match="silver_orders"):
        jobs.promotion_gate(
            report.withColumn(
                "passed",
                F.when(F.col("table_name") == "silver_orders", 0).otherwise(F.col("passed")),
            )
        )


def test_a_failed_source_does_not_stop_the_others(spark, extracts, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS partial_test")
    spark.catalog.setCurrentDatabase("partial_test")
    try:
        files.write_csv(extracts["products"], f"{tmp_path}/products.csv")
        outcomes = {o.table_name: o for o in jobs.run_bronze(spark, str(tmp_path))}
        assert outcomes["bronze_products"].success
        assert not outcomes["bronze_orders"].success
        assert outcomes["bronze_orders"].error_kind == "missing_source"
        with pytest.raises(Exception):
            jobs.run_silver(spark, DAY)
        results = jobs.run_gold(spark, DAY)
        assert {o.error_kind for o in results.values()} == {"missing_table"}
    finally:
        spark.sql("DROP DATABASE partial_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_gold_validation(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert jobs.validate_table(df, "t", ["a"]) == 2
    with pytest.raises(ValueError, match="lacks"):
        jobs.validate_table(df, "t", ["z"])
    with pytest.raises(ValueError, match="1 rows with a NULL"):
        jobs.validate_table(df, "t", ["a", "b"])
    with pytest.raises(ValueError, match="no rows"):
        jobs.validate_table(df.filter("false"), "t", ["a"])
    assert jobs.validate_table(df.filter("false"), "t", ["a"], allow_empty=True) == 0


def test_source_paths(monkeypatch):
    monkeypatch.delenv(fixed.SOURCE_FOLDER_VARIABLE, raising=False)
    assert files.resolve_source_path("a.csv") == "data/a.csv"
    monkeypatch.setenv(fixed.SOURCE_FOLDER_VARIABLE, "s3a://store/in/")
    assert files.resolve_source_path("a.csv") == "s3a://store/in/a.csv"
    assert files.resolve_source_path("a.csv", "/x") == "/x/a.csv"


def write(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_header_order_extra_and_missing_columns(spark, tmp_path):
    path = write(tmp_path / "p.csv", "price,extra,product_id,product_name\n9.50,e,7,Pen\n,,8,\n")
    df = files.read_csv(spark, path, schema=PRODUCTS.schema)
    assert df.columns == [*PRODUCTS.schema.fieldNames(), "extra"]
    rows = df.collect()
    assert (rows[0].product_id, str(rows[0].price), rows[0].category) == (7, "9.50", None)
    assert (rows[1].price, rows[1].product_name, rows[1].extra) == (None, None, None)
    landed = files.read_csv(spark, path)
    assert landed.columns == ["price", "extra", "product_id", "product_name"]
    assert {f.dataType.simpleString() for f in landed.schema} == {"string"}
    flagged_rows = silver.flagged_tables({"products": landed}, DAY, [PRODUCTS])["products"]
    assert flagged_rows.columns[: len(PRODUCTS.schema)] == PRODUCTS.schema.fieldNames()
    assert "extra" in flagged_rows.columns
    emails = silver.flagged_tables({"customers": landed.selectExpr("product_id AS customer_id")}, DAY, [CUSTOMERS])
    assert {r[VERDICT] for r in emails["customers"].collect()} == {"FAIL: FAIL: NULL email"}


def test_header_only_files_run_through(spark, tmp_path):
    for spec in TABLES:
        write(tmp_path / spec.source_file, ",".join(spec.schema.fieldNames()) + "\n")
    frames = {s.name: files.read_csv(spark, f"{tmp_path}/{s.source_file}") for s in TABLES}
    flagged_frames = silver.flagged_tables(frames, DAY)
    assert all(df.count() == 0 for df in flagged_frames.values())
    assert {r.pass_rate for r in metrics.quality_report(flagged_frames).collect()} == {1.0}
    sales = gold.sales_by_product(flagged_frames["orders"], flagged_frames["products"])
    assert sales.count() == 0


def test_encoding_and_its_probe(spark, tmp_path):
    text = "customer_id,customer_name\n1,José\n2,Ann\n"
    latin = write(tmp_path / "latin.csv", text, "latin-1")
    names = {r.customer_name for r in files.read_csv(spark, latin, encoding="ISO-8859-1").collect()}
    assert names == {"José", "Ann"}
    utf8 = write(tmp_path / "utf8.csv", text)
    wrong = files.read_csv(spark, utf8, encoding="ISO-8859-1")
    assert [r.customer_id for r in reconcile.mojibake_rows(wrong, "customer_name").collect()] == ["1"]
    right = files.read_csv(spark, utf8)
    assert reconcile.mojibake_rows(right, "customer_name").count() == 0


def test_audit_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "x\n1\n2\n")
    landed = files.read_csv(spark, path)
    per_file = files.add_audit_columns(landed, None).select("source_file").distinct().collect()
    assert per_file[0][0].endswith("/a.csv")
    assert {r.row_count for r in files.add_batch_row_count(landed).collect()} == {2}


def test_definitions_create_all_tables(spark):
    tables.create_tables(spark, "definitions_test")
    try:
        found = {t.name for t in spark.catalog.listTables("definitions_test")}
        assert found >= set(tables.DEFINITIONS) and len(tables.DEFINITIONS) == 10
        created = spark.table("definitions_test.gold_sales_by_product").schema
        assert [f.dataType for f in created] == [f.dataType for f in tables.SALES_BY_PRODUCT]
        tables.create_tables(spark, "definitions_test")
    finally:
        spark.sql("DROP DATABASE definitions_test CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_overwrite_replaces_rows_and_schema(spark):
    assert tables.overwrite_table(spark.range(3).toDF("a"), "overwrite_test") == 3
    assert tables.overwrite_table(spark.range(2).selectExpr("id", "'x' AS b"), "overwrite_test") == 2
    assert spark.table("overwrite_test").columns == ["id", "b"]
    assert tables.sample_rows(spark.table("overwrite_test"), 1).count() == 1
    tables.drop_table(spark, "overwrite_test")
    tables.drop_table(spark, "overwrite_test")


def test_metrics_per_column_come_with_the_write(spark, layers, monkeypatch):
    """With a run_id nothing reads Bronze again: what the report needs is observed while Silver is written."""

    def reads_again(*_):
        raise AssertionError("a second pass")

    spark.catalog.setCurrentDatabase("layers_test")
    bronze = {spec.name: spark.table(spec.bronze) for spec in TABLES}
    marked = silver.marked_tables(bronze, DAY)
    now = F.lit(None).cast("timestamp")
    wanted = metrics.union_all([metrics.extended_report(marked[s.name], s, "third", now) for s in TABLES])
    wanted = sorted(map(repr, wanted.drop("run_timestamp").collect()))
    monkeypatch.setattr(metrics, "extended_report", reads_again)
    jobs.run_silver(spark, DAY, run_id="third")
    found = spark.table(jobs.QUALITY_METRICS).filter("run_id = 'third'").drop("run_timestamp")
    assert sorted(map(repr, found.collect())) == wanted
    spark.catalog.setCurrentDatabase("default")


def _two_tables(spark, value):
    for name in ("switch_a", "switch_b"):
        tables.stage_table(spark.range(4).select("id", F.lit(value).alias("v")), name, version=f"v{value}")


def _values(spark):
    return [{r.v for r in spark.table(n).collect()} for n in ("switch_a", "switch_b")]


def test_a_switch_never_leaves_a_table_absent(spark, monkeypatch):
    names = ["switch_a", "switch_b"]
    _two_tables(spark, 1)
    tables.publish_tables(spark, names)
    pinned = tables.snapshot(spark, names)
    _two_tables(spark, 2)
    plain, seen = spark.sql, []

    def watched(statement, *args, **options):
        result = plain(statement, *args, **options)
        seen.append(_values(spark))
        return result

    monkeypatch.setattr(spark, "sql", watched)
    tables.publish_tables(spark, names)
    monkeypatch.undo()
    assert seen[0] == [{1}, {1}] and seen[-1] == [{2}, {2}]
    assert all(v in ({1}, {2}) for both in seen for v in both)
    assert {r.v for df in pinned.values() for r in df.collect()} == {1}  # still readable
    assert {r.v for df in tables.snapshot(spark, names).values() for r in df.collect()} == {2}

    _two_tables(spark, 3)

    def fails_at_b(statement, *args, **options):
        if statement.startswith("ALTER TABLE switch_b SET LOCATION"):
            raise RuntimeError("lost")
        return plain(statement, *args, **options)

    monkeypatch.setattr(spark, "sql", fails_at_b)
    with pytest.raises(RuntimeError):
        tables.publish_tables(spark, names)
    monkeypatch.undo()
    assert _values(spark) == [{2}, {2}]
    for value in (4, 5):
        _two_tables(spark, value)
        tables.publish_tables(spark, names)
    folder = tables.table_location(spark, "switch_a").rpartition("/")[0]
    assert files.folder_names(spark, folder) and len(files.folder_names(spark, folder)) == tables.VERSIONS_KEPT
    for name in names:
        tables.drop_table(spark, name)
    assert files.folder_names(spark, folder) == []


def test_tables_of_two_versions_are_no_snapshot(spark):
    _two_tables(spark, 1)
    tables.publish_tables(spark, ["switch_a", "switch_b"])
    tables.overwrite_table(spark.range(2).select("id", F.lit(9).alias("v")), "switch_b")
    with pytest.raises(ValueError, match="different versions"):
        tables.snapshot(spark, ["switch_a", "switch_b"], tries=1)
    for name in ("switch_a", "switch_b"):
        tables.drop_table(spark, name)


def test_a_partitioned_table_is_replaced(spark):
    for rows in (3, 5):
        df = spark.range(rows).select("id", (F.col("id") % 2).alias("half"))
        assert tables.overwrite_table(df, "halves_test", partition_by=["half"]) == rows
        assert spark.table("halves_test").filter("half = 0").count() == (rows + 1) // 2
    tables.drop_table(spark, "halves_test")


def test_header_only_files_run_through_the_jobs(spark, tmp_path):
    for spec in TABLES:
        write(tmp_path / spec.source_file, ",".join(spec.schema.fieldNames()) + "\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS empty_test")
    spark.catalog.setCurrentDatabase("empty_test")
    try:
        assert all(o.success and o.row_count == 0 for o in jobs.run_bronze(spark, str(tmp_path)))
        for run_id in ("one", "two"):
            found = jobs.run_silver(spark, DAY, run_id=run_id)
            assert {r.total_rows for r in found[jobs.QUALITY_REPORT].collect()} == {0}
        assert {r.failed for r in spark.table(jobs.QUALITY_METRICS).collect()} == {0}
        outcomes = jobs.run_gold(spark, DAY, allow_empty=True)
        assert all(o.success and o.row_count == 0 for o in outcomes.values()), outcomes
    finally:
        spark.sql("DROP DATABASE empty_test CASCADE")
        spark.catalog.setCurrentDatabase("default")
