"""SQL twins of the registered queries, written independently of the DataFrame code.

Each statement is a list of common table expressions over the given tables and one final SELECT.
"""

from __future__ import annotations

_AS_OF = "DATE '2001-08-02'"
_EMAIL = r"'^[^@\s]+@[^@\s]+\.[^@\s]+$'"

_FIXTURES = {
    "fx_customers": """
SELECT CASE WHEN c_custkey % 150 = 7 THEN c_custkey - 1 ELSE c_custkey END AS customer_id,
       c_name AS customer_name,
       CASE WHEN c_custkey % 30 = 3 THEN NULL
            WHEN c_custkey % 200 = 11 THEN 'not-an-email'
            ELSE lower(replace(c_name,'#','.')) || '@example.com' END AS email,
       n_name AS country,
       CASE WHEN c_custkey % 500 = 13 THEN DATE '2099-01-01'
            ELSE DATE '1990-01-01' + CAST(c_custkey % 1800 AS INT) END AS signup_date,
       c_mktsegment AS customer_segment,
       CAST(c_acctbal AS DECIMAL(18,2)) AS lifetime_value
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CASE WHEN p_partkey % 400 = 17 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(floor(p_retailprice) / 10 AS DECIMAL(18,2)) END AS price,
       CASE WHEN p_partkey % 300 = 29 THEN CAST(999 AS DECIMAL(18,2))
            WHEN p_partkey % 250 = 31 THEN NULL
            ELSE CAST(floor(p_retailprice) * (3 + p_partkey % 5) / 100 AS DECIMAL(18,2)) END AS cost,
       p_size * 20 AS stock_quantity,
       CAST(10 + p_partkey % 91 AS INT) AS reorder_level
FROM part""",
    "fx_orders": """
SELECT CASE WHEN o_orderkey % 1500 = 5 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
       CASE WHEN o_orderkey % 1000 = 21 THEN NULL
            WHEN o_orderkey % 2000 = 42 THEN 90000000 + o_orderkey ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 4000 = 123 THEN DATE '2099-01-01'
            ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderkey % 500 = 33 THEN NULL
            WHEN o_orderkey % 3000 = 77 THEN 90000000 + o_orderkey ELSE p_partkey END AS product_id,
       CASE WHEN o_orderkey % 2500 = 99 THEN 0 ELSE CAST(1 + o_orderkey % 10 AS INT) END AS quantity,
       CAST(floor(p_retailprice) / 10 AS DECIMAL(18,2)) AS unit_price,
       CASE WHEN o_orderkey % 3500 = 150 THEN CAST(-1 AS DECIMAL(18,2))
            ELSE CAST(floor(p_retailprice) * (1 + o_orderkey % 10) / 10 AS DECIMAL(18,2)) END AS total_amount,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END AS order_status,
       CASE WHEN o_orderstatus = 'F'
            THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 8 AS INT) END AS payment_date
FROM orders JOIN part ON p_partkey = (o_orderkey * 7) % (SELECT COUNT(*) FROM part)""",
}

_COMPLETE_CUSTOMERS = "CASE WHEN email IS NULL THEN 'FAIL: NULL email' ELSE 'PASS' END"
_COMPLETE_ORDERS = """CASE WHEN customer_id IS NULL THEN 'FAIL: NULL customer_id'
            WHEN product_id IS NULL THEN 'FAIL: NULL product_id' ELSE 'PASS' END"""
_TYPE_CUSTOMERS = f"""CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, {_EMAIL})
                 THEN 'FAIL: INVALID email - invalid email format'
            WHEN signup_date > {_AS_OF}
                 THEN 'FAIL: INVALID signup_date - invalid or future date' ELSE 'PASS' END"""
_TYPE_PRODUCTS = """CASE WHEN price <= 0 THEN 'FAIL: INVALID price - must be positive'
            WHEN cost IS NOT NULL AND NOT coalesce(cost > 0 AND cost < price, FALSE)
                 THEN 'FAIL: INVALID cost - must be positive and less than price' ELSE 'PASS' END"""
_TYPE_ORDERS = f"""CASE WHEN quantity <= 0 THEN 'FAIL: INVALID quantity - must be positive integer'
            WHEN total_amount <= 0 THEN 'FAIL: INVALID total_amount - must be positive decimal'
            WHEN order_date > {_AS_OF}
                 THEN 'FAIL: INVALID order_date - invalid or future date' ELSE 'PASS' END"""
_ORPHAN_CUSTOMER = """(customer_id IS NOT NULL AND NOT EXISTS
            (SELECT 1 FROM fx_customers c WHERE c.customer_id = o.customer_id))"""
_ORPHAN_PRODUCT = """(product_id IS NOT NULL AND NOT EXISTS
            (SELECT 1 FROM fx_products p WHERE p.product_id = o.product_id))"""


def _unique(key: str) -> str:
    return f"""CASE WHEN count(*) OVER (PARTITION BY {key}) > 1
            THEN 'FAIL: DUPLICATE {key}' ELSE 'PASS' END"""


_REFERENTIAL = f"""CASE WHEN {_ORPHAN_CUSTOMER} THEN 'FAIL: ORPHAN customer_id'
            WHEN {_ORPHAN_PRODUCT} THEN 'FAIL: ORPHAN product_id' ELSE 'PASS' END"""

_FLAGS = (
    "quality_completeness",
    "quality_uniqueness",
    "quality_type_validation",
    "quality_referential_integrity",
)
_ALL_PASS = " AND ".join(f"{c} = 'PASS'" for c in _FLAGS)
_VERDICT = f"""CASE WHEN {_ALL_PASS} THEN 'PASS' ELSE 'FAIL: ' || concat_ws(', ',
       {", ".join(f"nullif({c}, 'PASS')" for c in _FLAGS)}) END"""


def _silver(completeness: str, key: str, types: str, referential: str, source: str) -> str:
    return f"""
SELECT *, {_VERDICT} AS quality_check_result FROM (
  SELECT o.*, {completeness} AS quality_completeness,
         {_unique(key)} AS quality_uniqueness,
         {types} AS quality_type_validation,
         {referential} AS quality_referential_integrity
  FROM {source} o)"""


# ---- extracts landed as text -------------------------------------------------------------------

_DECIMAL = "TRY_CAST(trim({0}) AS DECIMAL(38,10))"


def _exactly(kind: str, column: str) -> str:
    """The number that a text says, if the type keeps all of it."""
    wide = _DECIMAL.format(column)
    return f"CASE WHEN TRY_CAST({wide} AS {kind}) = {wide} THEN TRY_CAST({wide} AS {kind}) END"


def _day(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({column}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN TRY_CAST(trim({column}) AS DATE) END"
    )


_TEXT_TYPES = {
    "customers": {
        "customer_id": "BIGINT", "customer_name": "", "email": "", "country": "", "signup_date": "DATE",
        "customer_segment": "", "lifetime_value": "DECIMAL(18,2)",
    },
    "products": {
        "product_id": "BIGINT", "product_name": "", "category": "", "price": "DECIMAL(18,2)",
        "cost": "DECIMAL(18,2)", "stock_quantity": "INT", "reorder_level": "INT",
    },
    "orders": {
        "order_id": "BIGINT", "customer_id": "BIGINT", "order_date": "DATE", "product_id": "BIGINT",
        "quantity": "INT", "unit_price": "DECIMAL(18,2)", "total_amount": "DECIMAL(18,2)",
        "order_status": "", "payment_date": "DATE",
    },
}
_ODD_TEXTS = {
    "customers": {
        "customer_id": "WHEN customer_id % 70 = 3 THEN customer_id || '.0' WHEN customer_id % 110 = 5 THEN ' ' || customer_id",
        "signup_date": "WHEN customer_id % 130 = 9 THEN '1994-05'",
    },
    "products": {
        "product_id": "WHEN product_id % 90 = 4 THEN ' ' || product_id WHEN product_id % 120 = 6 THEN product_id || '.0'",
        "price": "WHEN product_id % 150 = 9 THEN '12.345'",
        "cost": "WHEN product_id % 210 = 19 THEN 'NaN'",
        "stock_quantity": "WHEN product_id % 170 = 13 THEN '1e20' WHEN product_id % 190 = 17 THEN '7.0'",
        "reorder_level": "WHEN product_id % 230 = 23 THEN 'abc'",
    },
    "orders": {
        "order_id": "WHEN order_id % 900 = 7 THEN order_id || '.0' WHEN order_id % 1500 = 4 THEN ' ' || order_id "
        "WHEN order_id % 700 = 17 THEN 'abc'",
        "customer_id": "WHEN order_id % 80 = 19 THEN customer_id || '.0' WHEN order_id % 760 = 23 THEN 'x'",
        "product_id": "WHEN order_id % 95 = 11 THEN ' ' || product_id",
        "order_date": "WHEN order_id % 600 = 47 THEN '2000' WHEN order_id % 610 = 53 THEN '2000-05' "
        "WHEN order_id % 620 = 59 THEN '2000-02-03 junk'",
        "payment_date": "WHEN order_id % 630 = 61 THEN '2000-02-03T99'",
        "quantity": "WHEN order_id % 640 = 29 THEN '1e20' WHEN order_id % 650 = 31 THEN '3.0' "
        "WHEN order_id % 660 = 37 THEN '2.5'",
        "unit_price": "WHEN order_id % 670 = 67 THEN 'abc'",
        "total_amount": "WHEN order_id % 680 = 41 THEN '12.345' WHEN order_id % 690 = 43 THEN 'NaN'",
    },
}


def _landed(table: str) -> str:
    odd = _ODD_TEXTS[table]
    columns = [
        f"CASE {odd[c]} ELSE CAST({c} AS VARCHAR) END AS {c}" if c in odd else f"CAST({c} AS VARCHAR) AS {c}"
        for c in _TEXT_TYPES[table]
    ]
    return f"SELECT {', '.join(columns)} FROM fx_{table}"


def _typed(column: str, kind: str) -> str:
    if not kind:
        return column
    return _day(column) if kind == "DATE" else _exactly(kind, column)


def _silver_from_text(table: str, key: str, completeness: str, rules: str, referential: str) -> str:
    """Rules judge the text, then what no longer fits; all other flags see the typed values."""
    kinds = _TEXT_TYPES[table]
    typed = ", ".join(f"{_typed(c, kind)} AS {c}" for c, kind in kinds.items())
    names = {"BIGINT": "bigint", "INT": "int", "DATE": "date", "DECIMAL(18,2)": "decimal(18,2)"}
    unfitting = " ".join(
        f"WHEN {c} IS NOT NULL AND ({_typed(c, kind)}) IS NULL THEN 'FAIL: INVALID {c} - not {names[kind]}'"
        for c, kind in kinds.items()
        if kind
    )
    types = f"CASE {rules} {unfitting} ELSE 'PASS' END"
    return _silver(
        completeness, key, "landed_types", referential,
        f"(SELECT {typed}, {types} AS landed_types FROM tx_{table})",
    ).replace("SELECT o.*,", "SELECT o.* EXCLUDE (landed_types),")


def _number(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


_QUANTITY_TEXT = rf"""{_number('quantity')} > 0 AND floor({_number('quantity')}) = {_number('quantity')}
    AND abs({_number('quantity')}) <= 2147483647 AND regexp_matches(quantity, '^\s*[+-]?\d*\.?\d*\s*$')"""
_FROM_TEXT = {
    **{f"tx_{t}": _landed(t) for t in _TEXT_TYPES},
    "ts_customers": _silver_from_text(
        "customers", "customer_id", _COMPLETE_CUSTOMERS,
        f"""WHEN email IS NOT NULL AND NOT regexp_matches(email, {_EMAIL})
                THEN 'FAIL: INVALID email - invalid email format'
            WHEN signup_date IS NOT NULL AND NOT coalesce({_day('signup_date')} <= {_AS_OF}, FALSE)
                THEN 'FAIL: INVALID signup_date - invalid or future date'""",
        "'PASS'",
    ),
    "ts_products": _silver_from_text(
        "products", "product_id", "'PASS'",
        f"""WHEN price IS NOT NULL AND NOT coalesce({_number('price')} > 0, FALSE)
                THEN 'FAIL: INVALID price - must be positive'
            WHEN cost IS NOT NULL
                 AND NOT coalesce({_number('cost')} > 0 AND {_number('cost')} < {_number('price')}, FALSE)
                THEN 'FAIL: INVALID cost - must be positive and less than price'""",
        "'PASS'",
    ),
    "ts_orders": _silver_from_text(
        "orders", "order_id", _COMPLETE_ORDERS,
        f"""WHEN quantity IS NOT NULL AND NOT coalesce({_QUANTITY_TEXT}, FALSE)
                THEN 'FAIL: INVALID quantity - must be positive integer'
            WHEN total_amount IS NOT NULL AND NOT coalesce({_number('total_amount')} > 0, FALSE)
                THEN 'FAIL: INVALID total_amount - must be positive decimal'
            WHEN order_date IS NOT NULL AND NOT coalesce({_day('order_date')} <= {_AS_OF}, FALSE)
                THEN 'FAIL: INVALID order_date - invalid or future date'""",
        _REFERENTIAL,
    ),
    "text_sales": """
SELECT p.product_id, p.product_name, p.category,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(sum(o.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS total_revenue,
       round(CAST(sum(o.total_amount) AS DOUBLE) / count(o.total_amount), 4) AS avg_order_value,
       round((CAST(max(p.price) AS DOUBLE) - CAST(max(p.cost) AS DOUBLE))
             / CAST(max(p.price) AS DOUBLE) * 100, 2) AS profit_margin
FROM ts_orders o JOIN ts_products p ON o.product_id = p.product_id
WHERE o.quality_check_result = 'PASS' AND p.quality_check_result = 'PASS'
GROUP BY p.product_id, p.product_name, p.category""",
}


def _key_checks() -> str:
    counted = [
        f"SELECT 'DUPLICATE {t[:-1]}_id' AS key_check, "
        f"count(*) FILTER (WHERE quality_uniqueness <> 'PASS') AS row_count FROM ts_{t}"
        for t in _TEXT_TYPES
    ]
    counted += [
        f"SELECT 'ORPHAN {key}', count(*) FILTER (WHERE {orphan}) FROM ts_orders o"
        for key, orphan in (("customer_id", _ORPHAN_CUSTOMER), ("product_id", _ORPHAN_PRODUCT))
    ]
    union = " UNION ALL ".join(counted)
    return f"""SELECT seen_by, key_check, row_count FROM ({union})
CROSS JOIN (VALUES ('silver'), ('dimensions'), ('inventory')) AS views(seen_by)"""


_TABLES = {
    **_FIXTURES,
    "sv_customers": _silver(
        _COMPLETE_CUSTOMERS, "customer_id", _TYPE_CUSTOMERS, "'PASS'", "fx_customers"
    ),
    "sv_products": _silver("'PASS'", "product_id", _TYPE_PRODUCTS, "'PASS'", "fx_products"),
    "sv_orders": _silver(_COMPLETE_ORDERS, "order_id", _TYPE_ORDERS, _REFERENTIAL, "fx_orders"),
    **_FROM_TEXT,
    "ok_customers": "SELECT * FROM sv_customers WHERE quality_check_result = 'PASS'",
    "ok_products": "SELECT * FROM sv_products WHERE quality_check_result = 'PASS'",
    "ok_orders": "SELECT * FROM sv_orders WHERE quality_check_result = 'PASS'",
    "sales": """
SELECT p.product_id, p.product_name, p.category,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(sum(o.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS total_revenue,
       round(CAST(sum(o.total_amount) AS DOUBLE) / count(o.total_amount), 4) AS avg_order_value,
       round((CAST(max(p.price) AS DOUBLE) - CAST(max(p.cost) AS DOUBLE))
             / CAST(max(p.price) AS DOUBLE) * 100, 2) AS profit_margin
FROM ok_orders o JOIN ok_products p ON o.product_id = p.product_id
GROUP BY p.product_id, p.product_name, p.category""",
    "revenue": f"""
SELECT c.customer_id, c.customer_name, c.customer_segment, c.country,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS total_revenue,
       round(CAST(sum(o.total_amount) AS DOUBLE) / count(o.total_amount), 4) AS avg_order_value,
       min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
       CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS lifetime_value_actual,
       CAST(datediff('day', max(o.order_date), {_AS_OF}) AS INT) AS days_since_last_order
FROM ok_orders o JOIN ok_customers c ON o.customer_id = c.customer_id
GROUP BY c.customer_id, c.customer_name, c.customer_segment, c.country""",
    "classified": """
SELECT customer_id, total_orders, total_revenue,
       CASE WHEN days_since_last_order > 180 THEN 'Inactive'
            WHEN total_revenue > 10000 OR total_orders > 20 THEN 'High-Value'
            WHEN total_orders = 1 THEN 'One-Time'
            WHEN total_orders >= 5 AND total_orders <= 20 THEN 'Repeat'
            ELSE 'Regular' END AS segment_type
FROM revenue""",
    "segmentation": """
SELECT segment_type, count(*) AS customer_count,
       round(CAST(sum(total_revenue) AS DOUBLE) / count(*), 4) AS avg_revenue,
       CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue,
       round(CAST(sum(total_orders) AS DOUBLE) / count(*), 4) AS avg_orders,
       round(CAST(100.0 AS DOUBLE) * count(*) / (SELECT count(*) FROM classified), 2)
           AS pct_of_total_customers
FROM classified GROUP BY segment_type""",
    "tiers": """
SELECT c.customer_id, c.customer_name, c.country,
       CAST(coalesce(sum(o.total_amount), 0) AS DECIMAL(18,2)) AS total_revenue,
       count(DISTINCT o.order_id) AS total_orders,
       CASE WHEN count(DISTINCT o.order_id) = 0 THEN 'no_purchase'
            WHEN sum(o.total_amount) >= 5000 THEN 'high_value'
            WHEN sum(o.total_amount) >= 500 THEN 'medium_value'
            ELSE 'low_value' END AS revenue_segment,
       c.customer_segment AS source_customer_segment
FROM ok_customers c LEFT JOIN ok_orders o ON o.customer_id = c.customer_id
GROUP BY c.customer_id, c.customer_name, c.country, c.customer_segment""",
}

_CHECKS = (
    ("completeness", "quality_completeness"),
    ("uniqueness", "quality_uniqueness"),
    ("type_validation", "quality_type_validation"),
    ("referential_integrity", "quality_referential_integrity"),
    ("overall", "quality_check_result"),
)


def _report() -> str:
    rows = [
        f"""SELECT 'silver_{t}' AS table_name, '{check}' AS check_type, count(*) AS total_rows,
       count(*) FILTER (WHERE {column} = 'PASS') AS passed,
       count(*) FILTER (WHERE {column} <> 'PASS') AS failed,
       coalesce(round(count(*) FILTER (WHERE {column} = 'PASS') / CAST(count(*) AS DOUBLE), 4), 1.0)
           AS pass_rate
FROM sv_{t}"""
        for t in ("customers", "products", "orders")
        for check, column in _CHECKS
    ]
    return "\nUNION ALL\n".join(rows)


def _trend(extra: str = "") -> str:
    return f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       CAST(sum(total_amount) AS DOUBLE) AS monthly_revenue,
       count(DISTINCT order_id) AS monthly_orders
FROM ok_orders WHERE TRUE {extra} GROUP BY 1 ORDER BY 1"""


_BUCKET = """CASE WHEN total_revenue < 100 THEN '0-100' WHEN total_revenue < 500 THEN '100-500'
     WHEN total_revenue < 1000 THEN '500-1000' WHEN total_revenue < 5000 THEN '1000-5000'
     WHEN total_revenue < 10000 THEN '5000-10000' ELSE '10000+' END"""
_BUCKET_ORDER = """CAST(CASE WHEN total_revenue < 100 THEN 1 WHEN total_revenue < 500 THEN 2
     WHEN total_revenue < 1000 THEN 3 WHEN total_revenue < 5000 THEN 4
     WHEN total_revenue < 10000 THEN 5 ELSE 6 END AS INT)"""


def _histogram(where: str = "TRUE") -> str:
    return f"""SELECT {_BUCKET} AS revenue_bucket, count(*) AS customer_count,
       {_BUCKET_ORDER} AS bucket_order
FROM revenue WHERE {where} GROUP BY 1, 3"""


_REQUIRED = {
    "customers": ("customer_id", "customer_name", "email", "country", "signup_date"),
    "products": ("product_id", "product_name", "category", "price"),
    "orders": (
        "order_id", "customer_id", "product_id", "order_date",
        "quantity", "unit_price", "total_amount", "order_status",
    ),
}


def _filled(column: str) -> str:
    return f"coalesce(trim(CAST({column} AS VARCHAR)) <> '', FALSE)"


def _all_filled(table: str) -> str:
    return "(" + " AND ".join(_filled(c) for c in _REQUIRED[table]) + ")"


def _required() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'silver_{t}' AS table_name, {t[:-1]}_id AS row_key, "
        f"{_all_filled(t)} AS completeness_pass FROM fx_{t}"
        for t in _REQUIRED
    )


def _null_metric(table: str, field: str) -> str:
    return f"""SELECT 'bronze_{table}' AS table_name, '{field}' AS field_name, count(*) AS total_rows,
       count(*) - count({field}) AS null_count,
       CAST(count({field}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS pass_rate
FROM fx_{table}"""


def _unique_metric(table: str) -> str:
    key = f"{table[:-1]}_id"
    return f"""SELECT 'bronze_{table}' AS table_name, '{key}' AS field_name, count(*) AS total_rows,
       count(*) FILTER (WHERE n > 1) AS duplicate_rows,
       CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS pass_rate
FROM (SELECT count(*) OVER (PARTITION BY {key}) AS n FROM fx_{table})"""


def _rule_metric(table: str, field: str, label: str, valid: str) -> str:
    return f"""SELECT 'bronze_{table}' AS table_name, '{field}' AS field_name, '{label}' AS rule_name,
       count({field}) AS evaluated_rows,
       count(*) FILTER (WHERE {field} IS NOT NULL AND NOT coalesce({valid}, FALSE)) AS invalid_rows,
       CAST(count(*) FILTER (WHERE {field} IS NOT NULL AND coalesce({valid}, FALSE)) AS DOUBLE)
           / CAST(count({field}) AS DOUBLE) * 100.0 AS pass_rate
FROM fx_{table}"""


def _orphans(orphan: str, key: str) -> str:
    return f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE {orphan}) AS orphan_rows,
       count(DISTINCT CASE WHEN {orphan} THEN {key} END) AS orphan_keys
FROM fx_orders o"""


def _orphan_metric(orphan: str, key: str) -> str:
    return f"""SELECT '{key} referential' AS check_name, count(*) AS total_rows,
       count(*) FILTER (WHERE {orphan}) AS orphan_rows,
       CAST(count(*) FILTER (WHERE NOT {orphan}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0
           AS pass_rate
FROM fx_orders o"""


def _extended_row(table: str, check: str, column: str, passed: str) -> str:
    return f"""SELECT 'run-2001-08-02' AS run_id, TIMESTAMP '2001-08-02 06:00:00' AS run_timestamp,
       'silver_{table}' AS table_name, '{check}' AS check_name, CAST({column} AS VARCHAR) AS column_name,
       count(*) AS total_rows, count(*) FILTER (WHERE {passed}) AS passed,
       count(*) FILTER (WHERE NOT ({passed})) AS failed,
       coalesce(round(count(*) FILTER (WHERE {passed}) / CAST(count(*) AS DOUBLE), 4), 1.0) AS pass_rate
FROM sv_{table} o"""


def _extended() -> str:
    rows = [
        _extended_row("customers", "completeness", "'email'", "email IS NOT NULL"),
        _extended_row("orders", "completeness", "'customer_id'", "customer_id IS NOT NULL"),
        _extended_row("orders", "completeness", "'product_id'", "product_id IS NOT NULL"),
        _extended_row("orders", "referential_integrity", "'customer_id'", f"NOT {_ORPHAN_CUSTOMER}"),
        _extended_row("orders", "referential_integrity", "'product_id'", f"NOT {_ORPHAN_PRODUCT}"),
    ]
    for t in _REQUIRED:
        rows += [
            _extended_row(t, "completeness", "'all_required'", _all_filled(t)),
            _extended_row(t, "uniqueness", f"'{t[:-1]}_id'", "quality_uniqueness = 'PASS'"),
            _extended_row(t, "type_validation", "'all'", "quality_type_validation = 'PASS'"),
            _extended_row(t, "overall_pass", "NULL", "quality_check_result = 'PASS'"),
        ]
    return "\nUNION ALL\n".join(rows)


def _pass_summary() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'silver_{t}' AS table_name, "
        f"count(*) FILTER (WHERE quality_check_result = 'PASS') AS pass_rows, "
        f"count(*) AS total_rows FROM sv_{t}"
        for t in _REQUIRED
    )


def _layer_counts() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {prefix}_{t}"
        for layer, prefix in (("bronze", "fx"), ("silver", "sv"))
        for t in _REQUIRED
    )


def _stored_counts() -> str:
    tables = [(f"bronze_{t}", f"fx_{t}", True) for t in _REQUIRED]
    tables += [(f"silver_{t}", f"sv_{t}", False) for t in _REQUIRED]
    tables += [
        ("gold_sales_by_product", "sales", False),
        ("gold_revenue_by_customer", "revenue", False),
        ("gold_customer_segmentation", "segmentation", False),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, {'count(*)' if landed else 'CAST(NULL AS BIGINT)'} AS rows_written, "
        f"count(*) AS row_count FROM {source}"
        for name, source, landed in tables
    )


def _validation() -> str:
    rows = []
    for t in _REQUIRED:
        expected = (
            "(SELECT count(*) FROM part WHERE p_partkey % 400 = 17 OR p_partkey % 300 = 29)"
            if t == "products"
            else "CAST(NULL AS BIGINT)"
        )
        rows.append(
            f"""SELECT 'silver_{t}' AS table_name, count(*) AS silver_rows,
       count(*) FILTER (WHERE quality_check_result IS NULL) AS null_verdicts,
       count(*) FILTER (WHERE quality_check_result <> 'PASS') AS failed_rows,
       (SELECT count(*) FROM fx_{t}) AS bronze_rows, {expected} AS expected_failed
FROM sv_{t}"""
        )
    union = "\nUNION ALL\n".join(rows)
    return f"""SELECT *, silver_rows >= bronze_rows AND null_verdicts = 0
       AND coalesce(failed_rows = expected_failed, TRUE) AS is_valid FROM ({union})"""


def _inventory() -> str:
    def row(table: str, defect: str, counted: str) -> str:
        return (
            f"SELECT 'bronze_{table}' AS table_name, '{defect}' AS defect, "
            f"count(*) FILTER (WHERE {counted}) AS row_count FROM fx_{table} o"
        )

    def duplicates(table: str) -> str:
        key = f"{table[:-1]}_id"
        return (
            f"SELECT 'bronze_{table}' AS table_name, 'DUPLICATE {key}' AS defect, "
            f"count(*) FILTER (WHERE n > 1) AS row_count "
            f"FROM (SELECT count(*) OVER (PARTITION BY {key}) AS n FROM fx_{table})"
        )

    rows = [row(t, "total rows", "TRUE") for t in _REQUIRED]
    rows += [duplicates(t) for t in _REQUIRED]
    rows += [
        row("customers", "NULL email", "email IS NULL"),
        row("orders", "NULL customer_id", "customer_id IS NULL"),
        row("orders", "NULL product_id", "product_id IS NULL"),
        row("orders", "ORPHAN customer_id", _ORPHAN_CUSTOMER),
        row("orders", "ORPHAN product_id", _ORPHAN_PRODUCT),
    ]
    return "\nUNION ALL\n".join(rows)


def _injected() -> str:
    c, p, o = "c_custkey", "p_partkey", "o_orderkey"
    rows = [
        ("customers", "duplicate customer_id", "customer", f"{c} % 150 = 7"),
        ("customers", "NULL email", "customer", f"{c} % 30 = 3"),
        ("customers", "malformed email", "customer", f"{c} % 200 = 11 AND {c} % 30 <> 3"),
        ("customers", "future signup_date", "customer", f"{c} % 500 = 13"),
        ("products", "zero price", "part", f"{p} % 400 = 17"),
        ("products", "cost above price", "part", f"{p} % 300 = 29"),
        ("products", "NULL cost", "part", f"{p} % 250 = 31 AND {p} % 300 <> 29"),
        ("orders", "duplicate order_id", "orders", f"{o} % 1500 = 5"),
        ("orders", "NULL customer_id", "orders", f"{o} % 1000 = 21"),
        ("orders", "orphan customer_id", "orders", f"{o} % 2000 = 42 AND {o} % 1000 <> 21"),
        ("orders", "future order_date", "orders", f"{o} % 4000 = 123"),
        ("orders", "NULL product_id", "orders", f"{o} % 500 = 33"),
        ("orders", "orphan product_id", "orders", f"{o} % 3000 = 77 AND {o} % 500 <> 33"),
        ("orders", "zero quantity", "orders", f"{o} % 2500 = 99"),
        ("orders", "negative total_amount", "orders", f"{o} % 3500 = 150"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{defect}' AS defect, "
        f"count(*) FILTER (WHERE {where}) AS row_count FROM {source}"
        for t, defect, source, where in rows
    )


def _dimension_metrics() -> str:
    parts = {
        "completeness": [
            _null_metric("customers", "email"), _null_metric("orders", "customer_id"), _null_metric("orders", "product_id"),
        ],
        "uniqueness": [_unique_metric(t) for t in _REQUIRED],
        "type_validation": _TYPE_METRICS,
        "referential_integrity": [
            _orphan_metric(_ORPHAN_CUSTOMER, "customer_id"), _orphan_metric(_ORPHAN_PRODUCT, "product_id"),
        ],
    }
    columns = {
        "completeness": "table_name, field_name, null_count",
        "uniqueness": "table_name, field_name, duplicate_rows",
        "type_validation": "table_name, rule_name, invalid_rows",
        "referential_integrity": "'bronze_orders' AS table_name, check_name, orphan_rows",
    }
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, table_name, measure, failed_rows, pass_rate FROM "
        f"(SELECT {columns[d]}, pass_rate FROM ({part})) AS m(table_name, measure, failed_rows, pass_rate)"
        for d, listed in parts.items()
        for part in listed
    )


_TYPE_METRICS = [
    _rule_metric("customers", "email", "email format", f"regexp_matches(email, {_EMAIL})"),
    _rule_metric("customers", "signup_date", "valid date not in future", f"signup_date <= {_AS_OF}"),
    _rule_metric("orders", "quantity", "positive integer", "quantity > 0 AND floor(quantity) = quantity"),
    _rule_metric("orders", "total_amount", "positive decimal", "total_amount > 0"),
    _rule_metric("orders", "order_date", "valid date not in future", f"order_date <= {_AS_OF}"),
    _rule_metric("products", "price", "positive price", "price > 0"),
    _rule_metric("products", "cost", "positive and less than price", "cost > 0 AND cost < price"),
]


_EXTENDED_TYPES = f"""
SELECT 'silver_customers' AS table_name, customer_id AS row_key,
       CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, {_EMAIL})
                 THEN 'FAIL: INVALID email - invalid email format'
            WHEN customer_id % 40 = 2 THEN 'FAIL: INVALID lifetime_value - must be numeric'
            ELSE 'PASS' END AS quality_type_validation
FROM fx_customers
UNION ALL
SELECT 'silver_products', product_id,
       CASE WHEN price < 0 THEN 'FAIL: INVALID price - must be non-negative decimal'
            WHEN cost < 0 THEN 'FAIL: INVALID cost - must be non-negative decimal'
            WHEN product_id % 60 = 2 OR stock_quantity < 0
                 THEN 'FAIL: INVALID stock_quantity - must be non-negative integer'
            WHEN reorder_level < 0
                 THEN 'FAIL: INVALID reorder_level - must be non-negative integer'
            ELSE 'PASS' END
FROM fx_products
UNION ALL
SELECT 'silver_orders', order_id,
       CASE WHEN quantity <= 0 THEN 'FAIL: INVALID quantity - must be positive integer'
            WHEN order_id % 700 = 2 OR unit_price < 0
                 THEN 'FAIL: INVALID unit_price - must be non-negative decimal'
            WHEN total_amount < 0 THEN 'FAIL: INVALID total_amount - must be non-negative decimal'
            ELSE 'PASS' END
FROM fx_orders"""

_BUSINESS = f"""
SELECT order_id, quantity, total_amount,
       CASE WHEN codes = '' THEN 'PASS' ELSE 'FAIL_BUSINESS_LOGIC:' || codes END AS quality_business_logic
FROM (SELECT *, concat_ws(',',
        CASE WHEN quantity <= 0 THEN 'QUANTITY' END,
        CASE WHEN unit_price < 0 THEN 'PRICE' END,
        CASE WHEN total_amount < 0 THEN 'AMOUNT' END,
        CASE WHEN order_date > {_AS_OF} THEN 'ORDER_DATE' END,
        CASE WHEN lower(order_status) NOT IN ('completed', 'pending', 'cancelled') THEN 'STATUS' END,
        CASE WHEN total_amount <> quantity * unit_price THEN 'AMOUNT_MISMATCH' END) AS codes
      FROM fx_orders)"""

_CODES = """concat_ws(',',
        CASE WHEN quality_completeness <> 'PASS' THEN 'COMPLETENESS' END,
        CASE WHEN quality_uniqueness <> 'PASS' THEN 'UNIQUENESS' END,
        CASE WHEN quality_type_validation <> 'PASS' THEN 'TYPE_VALIDATION' END,
        CASE WHEN quality_referential_integrity <> 'PASS' THEN 'REFERENTIAL_INTEGRITY' END)"""

_CONCENTRATION = f"""
SELECT revenue_bucket, bucket_order, customer_count, total_revenue,
       round(CAST(total_revenue AS DOUBLE) * 100.0 / CAST(sum(total_revenue) OVER () AS DOUBLE), 2)
           AS pct_of_revenue,
       round(CAST(sum(total_revenue) OVER (ORDER BY bucket_order DESC
                                           ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100.0
             / CAST(sum(total_revenue) OVER () AS DOUBLE), 2) AS cumulative_pct
FROM (SELECT {_BUCKET} AS revenue_bucket, {_BUCKET_ORDER} AS bucket_order, count(*) AS customer_count,
             CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue
      FROM revenue GROUP BY 1, 2)"""

_PICK_TOP_PRODUCTS = """SELECT product_name, category, total_revenue, total_quantity, total_orders
FROM sales {where} ORDER BY total_revenue DESC, product_id LIMIT 10"""

_FINAL = {
    "csv_roundtrip_scan": "SELECT * FROM fx_orders",
    "bronze_audit_columns": """SELECT *, TIMESTAMP '2001-08-02 06:00:00' AS ingestion_timestamp,
       'landing/customers.csv' AS source_file FROM fx_customers""",
    "bronze_batch_row_count": "SELECT product_id, (SELECT count(*) FROM part) AS row_count FROM fx_products",
    "raw_defect_inventory": _inventory(),
    "injected_defect_summary": _injected(),
    "probe_mojibake": """SELECT customer_id, 'JosÃ© ' || customer_name AS customer_name
FROM fx_customers WHERE customer_id % 50 = 9""",
    "probe_column_types": """
SELECT 'product_id' AS column_name, lower(any_value(typeof(product_id))) AS column_type,
       count(*) AS row_count, count(product_id) AS value_count FROM fx_products
UNION ALL SELECT 'price', lower(any_value(typeof(price))), count(*), count(price) FROM fx_products
UNION ALL SELECT 'cost', lower(any_value(typeof(cost))), count(*), count(cost) FROM fx_products""",
    "landing_by_header": "SELECT *, upper(product_name) AS remark FROM fx_products",
    "landing_of_headers_alone": "\nUNION ALL\n".join(
        f"SELECT 'silver_{t}' AS table_name, '{check}' AS check_type, count(*) AS total_rows, count(*) AS failed, "
        f"CAST(1 AS DOUBLE) AS pass_rate FROM fx_{t} WHERE FALSE"
        for t in _REQUIRED
        for check, _ in _CHECKS
    ),
    "landing_in_latin1": "SELECT customer_id, 'José ' || customer_name AS customer_name FROM fx_customers",
    "stored_layer_counts": _stored_counts(),
    "landing_outcomes": """
SELECT 'bronze_customers' AS table_name, TRUE AS success, count(*) AS row_count, CAST(NULL AS VARCHAR) AS error_kind FROM fx_customers
UNION ALL SELECT 'bronze_products', FALSE, 0, 'missing_source'
UNION ALL SELECT 'bronze_orders', TRUE, count(*), NULL FROM fx_orders""",
    "verdict_without_flags": "SELECT order_id, 'PASS' AS quality_check_result FROM fx_orders",
    "promotion_blocked_tables": f"""SELECT *, 'critical' AS alert_level, FALSE AS below_check_limit
FROM ({_report()}) WHERE check_type = 'overall' AND passed < 0.99 * total_rows""",
    "dimension_metrics": _dimension_metrics(),
    "dimension_flags": f"""
SELECT 'quality_completeness' AS dimension, {_COMPLETE_ORDERS} AS flag, count(*) AS row_count FROM fx_orders GROUP BY 2
UNION ALL SELECT 'quality_uniqueness', flag, count(*) FROM (SELECT {_unique("order_id")} AS flag FROM fx_orders) GROUP BY flag
UNION ALL SELECT 'quality_type_validation', {_TYPE_ORDERS} AS flag, count(*) FROM fx_orders GROUP BY 2
UNION ALL SELECT 'quality_referential_integrity', flag, count(*)
FROM (SELECT {_REFERENTIAL} AS flag FROM fx_orders o) GROUP BY flag""",
    "stored_top_products": _PICK_TOP_PRODUCTS.format(where=""),
    "stored_revenue_histogram": _histogram(),
    "stored_segmentation": """SELECT segment_type, customer_count, pct_of_total_customers,
       total_revenue, avg_revenue, avg_orders FROM segmentation""",
    "stored_monthly_trend": _trend(),
    "dq_completeness_customers": f"""SELECT customer_id, email, {_COMPLETE_CUSTOMERS} AS quality_completeness
FROM fx_customers""",
    "dq_completeness_orders": f"""SELECT order_id, customer_id, product_id,
       {_COMPLETE_ORDERS} AS quality_completeness FROM fx_orders""",
    "dq_completeness_required": _required(),
    "dq_completeness_failed_columns": f"""SELECT order_id, concat_ws(',',
       {", ".join(f"CASE WHEN NOT {_filled(c)} THEN '{c}' END" for c in _REQUIRED["orders"])})
       AS completeness_failed_columns FROM fx_orders""",
    "dq_metric_completeness": "\nUNION ALL\n".join(
        [
            _null_metric("customers", "email"),
            _null_metric("orders", "customer_id"),
            _null_metric("orders", "product_id"),
        ]
    ),
    "dq_uniqueness_customers": f"""SELECT customer_id, customer_name,
       {_unique("customer_id")} AS quality_uniqueness FROM fx_customers""",
    "dq_uniqueness_orders": f"""SELECT order_id, total_amount,
       {_unique("order_id")} AS quality_uniqueness FROM fx_orders""",
    "dq_uniqueness_products": f"""SELECT product_id,
       {_unique("product_id")} AS quality_uniqueness FROM fx_products""",
    "dq_uniqueness_lineitem": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
            THEN 'FAIL: DUPLICATE l_orderkey,l_linenumber' ELSE 'PASS' END AS quality_uniqueness
FROM lineitem""",
    "dq_uniqueness_keep_first": """SELECT order_id, order_date, customer_id, total_amount,
       CASE WHEN row_number() OVER (PARTITION BY order_id
                 ORDER BY order_date NULLS FIRST, customer_id NULLS FIRST, total_amount NULLS FIRST) = 1
            THEN 'PASS' ELSE 'FAIL: DUPLICATE order_id' END AS quality_uniqueness FROM fx_orders""",
    "dq_uniqueness_keep_first_lineitem": """SELECT l_orderkey, l_suppkey, l_linenumber,
       CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber) = 1
            THEN 'PASS' ELSE 'FAIL: DUPLICATE l_orderkey,l_suppkey' END AS quality_uniqueness
FROM lineitem""",
    "gold_sales_distinct_orders": "SELECT product_id, total_orders FROM sales",
    "monthly_orders_distinct": f"SELECT month, monthly_orders FROM ({_trend()})",
    "dq_metric_uniqueness": "\nUNION ALL\n".join(_unique_metric(t) for t in _REQUIRED),
    "dq_type_customers": f"""SELECT customer_id, email, signup_date,
       {_TYPE_CUSTOMERS} AS quality_type_validation FROM fx_customers""",
    "dq_type_orders": f"""SELECT order_id, quantity, total_amount, order_date,
       {_TYPE_ORDERS} AS quality_type_validation FROM fx_orders""",
    "dq_type_products": f"""SELECT product_id, price, cost,
       {_TYPE_PRODUCTS} AS quality_type_validation FROM fx_products""",
    "dq_type_extended": _EXTENDED_TYPES,
    "dq_metric_type_rules": "\nUNION ALL\n".join(_TYPE_METRICS),
    "silver_standardize": "SELECT * FROM fx_orders",
    "dq_orphans_customer": _orphans(_ORPHAN_CUSTOMER, "customer_id"),
    "dq_orphans_product": _orphans(_ORPHAN_PRODUCT, "product_id"),
    "dq_metric_referential": "\nUNION ALL\n".join(
        [
            _orphan_metric(_ORPHAN_CUSTOMER, "customer_id"),
            _orphan_metric(_ORPHAN_PRODUCT, "product_id"),
        ]
    ),
    "dq_referential_orders": f"""SELECT order_id, customer_id, product_id,
       {_REFERENTIAL} AS quality_referential_integrity FROM fx_orders o""",
    "dq_referential_detail": f"""SELECT order_id, customer_id, product_id,
       CASE WHEN {_ORPHAN_CUSTOMER} AND {_ORPHAN_PRODUCT} THEN 'BOTH'
            WHEN {_ORPHAN_CUSTOMER} THEN 'MISSING_CUSTOMER'
            WHEN {_ORPHAN_PRODUCT} THEN 'MISSING_PRODUCT' END AS referential_failure_detail
FROM fx_orders o""",
    "dq_business_rules": _BUSINESS,
    "silver_customers": "SELECT * FROM sv_customers",
    "silver_products": "SELECT * FROM sv_products",
    "silver_orders": "SELECT * FROM sv_orders",
    "silver_pass_filter": "SELECT order_id, customer_id, total_amount FROM ok_orders",
    "quarantine_orders": "SELECT * FROM sv_orders WHERE quality_check_result <> 'PASS'",
    "rows_by_failure_reason": """SELECT order_id, customer_id, quality_check_result FROM sv_orders
WHERE quality_check_result LIKE '%ORPHAN customer\\_id%' ESCAPE '\\'""",
    "dq_composite_code": f"""SELECT order_id,
       CASE WHEN codes = '' THEN 'PASS' WHEN codes LIKE '%,%' THEN 'FAIL_MULTIPLE:' || codes
            ELSE 'FAIL_' || codes END AS quality_code,
       nullif(lower(codes), '') AS quality_failure_reasons
FROM (SELECT order_id, {_CODES} AS codes FROM sv_orders)""",
    "dq_first_failure": f"""SELECT order_id,
       CASE WHEN codes = '' THEN 'PASS' ELSE 'FAIL_' || split_part(codes, ',', 1) END AS quality_code
FROM (SELECT order_id, {_CODES} AS codes FROM sv_orders)""",
    "silver_quality_report": _report(),
    "quality_metrics_extended": _extended(),
    "quality_alert_level": f"""SELECT *,
       CASE WHEN pass_rate >= 0.995 THEN 'normal' WHEN pass_rate >= 0.99 THEN 'warning'
            ELSE 'critical' END AS alert_level,
       CASE check_type WHEN 'completeness' THEN pass_rate < 0.99 WHEN 'uniqueness' THEN pass_rate < 0.999
            WHEN 'type_validation' THEN pass_rate < 0.995
            WHEN 'referential_integrity' THEN pass_rate < 0.999 ELSE FALSE END AS below_check_limit
FROM ({_report()})""",
    "failures_by_reason": """SELECT quality_check_result, count(*) AS row_count
FROM sv_orders GROUP BY 1""",
    "silver_pass_summary": _pass_summary(),
    "overall_pass_rate": f"""SELECT CAST(sum(total_rows) AS BIGINT) AS total_rows,
       CAST(sum(pass_rows) AS BIGINT) AS pass_rows,
       CAST(sum(pass_rows) AS DOUBLE) / CAST(sum(total_rows) AS DOUBLE) * 100.0 AS pass_rate_pct
FROM ({_pass_summary()})""",
    "layer_row_counts": _layer_counts(),
    "silver_validation": _validation(),
    "silver_customers_from_text": "SELECT * FROM ts_customers",
    "silver_products_from_text": "SELECT * FROM ts_products",
    "silver_orders_from_text": "SELECT * FROM ts_orders",
    "gold_sales_from_text": "SELECT * FROM text_sales",
    "key_checks_from_text": _key_checks(),
    "gold_sales_by_product": "SELECT * FROM sales",
    "gold_revenue_by_customer": "SELECT * FROM revenue",
    "gold_customer_segmentation": "SELECT * FROM segmentation",
    "customer_segment_rows": "SELECT * FROM classified",
    "sales_by_product_lines": """
SELECT p.product_id, p.product_name, p.category,
       CAST(sum(o.quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(o.total_amount) AS DECIMAL(18,2)) AS total_revenue,
       count(*) AS order_line_count,
       round(CAST(sum(o.unit_price) AS DOUBLE) / count(o.unit_price), 4) AS avg_unit_price
FROM ok_orders o JOIN ok_products p ON o.product_id = p.product_id
GROUP BY p.product_id, p.product_name, p.category""",
    "revenue_by_customer_ratio_aov": """
SELECT customer_id, customer_name, country, total_orders, total_revenue,
       round(CAST(total_revenue AS DOUBLE) / total_orders, 4) AS avg_order_value,
       first_order_date, last_order_date FROM revenue""",
    "segmentation_value_tiers": "SELECT * FROM tiers",
    "gold_daily_trend": """
SELECT order_date AS order_day, CAST(year(order_date) AS INT) AS year,
       CAST(weekofyear(order_date) AS INT) AS week, count(order_id) AS order_count,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS daily_revenue
FROM ok_orders GROUP BY order_date""",
    "gold_weekly_trend": """
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, count(order_id) AS order_count,
       CAST(sum(total_amount) AS DECIMAL(18,2)) AS weekly_revenue
FROM ok_orders GROUP BY 1""",
    "gold_key_null_check": """
SELECT 'gold_sales_by_product' AS table_name, count(*) AS row_count,
       count(*) FILTER (WHERE product_id IS NULL OR product_name IS NULL OR category IS NULL
                        OR total_revenue IS NULL) AS null_key_rows FROM sales
UNION ALL
SELECT 'gold_revenue_by_customer', count(*),
       count(*) FILTER (WHERE customer_id IS NULL OR customer_name IS NULL OR total_revenue IS NULL)
FROM revenue
UNION ALL
SELECT 'gold_customer_segmentation', count(*),
       count(*) FILTER (WHERE segment_type IS NULL OR customer_count IS NULL OR total_revenue IS NULL)
FROM segmentation""",
    "gold_reconciliation": """
SELECT s AS silver_pass_revenue, p AS product_revenue, c AS customer_revenue,
       CAST(s - p AS DECIMAL(28,2)) AS lost_to_failed_products,
       CAST(s - c AS DECIMAL(28,2)) AS lost_to_failed_customers
FROM (SELECT CAST((SELECT sum(total_amount) FROM ok_orders) AS DECIMAL(28,2)) AS s,
             CAST((SELECT sum(total_revenue) FROM sales) AS DECIMAL(28,2)) AS p,
             CAST((SELECT sum(total_revenue) FROM revenue) AS DECIMAL(28,2)) AS c)""",
    "segment_total_check": """
SELECT CAST(sum(customer_count) AS BIGINT) AS segmented_customers,
       (SELECT count(*) FROM revenue) AS customers_with_orders,
       sum(customer_count) <= (SELECT count(*) FROM revenue) AS is_valid
FROM segmentation""",
    "probe_null_order_value": """SELECT count(*) AS row_count,
       count(*) FILTER (WHERE avg_order_value IS NULL) AS null_avg_order_value FROM revenue""",
    "dash_top_products": _PICK_TOP_PRODUCTS.format(where=""),
    "dash_filtered_products": _PICK_TOP_PRODUCTS.format(
        where="WHERE category = 'ECONOMY' AND total_revenue > 1000"
    ),
    "dash_top_customers": """SELECT customer_id, customer_name, country, total_orders, total_revenue
FROM revenue ORDER BY total_revenue DESC, customer_id LIMIT 15""",
    "dash_revenue_histogram": _histogram(),
    "dash_hist_by_segment": _histogram("customer_segment IN ('BUILDING', 'MACHINERY')"),
    "dash_hist_by_country": _histogram("country = 'NATION_7'"),
    "dash_histogram_design": """
SELECT CASE WHEN total_revenue < 100 THEN '0-99' WHEN total_revenue < 500 THEN '100-499'
            WHEN total_revenue < 1000 THEN '500-999' WHEN total_revenue < 5000 THEN '1000-4999'
            ELSE '5000+' END AS revenue_bucket,
       count(*) AS customer_count, min(total_revenue) AS min_revenue
FROM revenue GROUP BY 1""",
    "dash_segmentation": """SELECT segment_type, customer_count, pct_of_total_customers,
       total_revenue, avg_revenue, avg_orders FROM segmentation""",
    "dash_filtered_segmentation": """SELECT segment_type, customer_count, pct_of_total_customers,
       total_revenue, avg_revenue, avg_orders FROM segmentation
WHERE segment_type IN ('High-Value', 'Repeat') AND customer_count > 10""",
    "dash_monthly_trend": _trend(),
    "dash_filtered_trend": _trend(
        f"AND order_date >= {_AS_OF} - 365 AND order_status = 'Completed'"
    ),
    "dash_trend_date_range": _trend("AND order_date BETWEEN DATE '1997-03-15' AND DATE '1999-10-31'"),
    "dash_segment_share": """
SELECT revenue_segment, count(*) AS customer_count,
       round(CAST(100.0 AS DOUBLE) * count(*) / (SELECT count(*) FROM tiers), 1) AS pct_of_customers
FROM tiers GROUP BY revenue_segment""",
    "dash_category_breakdown": """
SELECT category, count(*) AS product_count, CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(total_quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue
FROM sales GROUP BY category""",
    "dash_revenue_concentration": _CONCENTRATION,
}


def statements() -> dict[str, str]:
    tables = ",\n".join(f"{name} AS ({body})" for name, body in _TABLES.items())
    return {name: f"WITH {tables}\n{final}" for name, final in _FINAL.items()}
