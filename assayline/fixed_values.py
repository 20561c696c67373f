"""The texts, patterns and limits that results must show exactly."""

# ---- fixed values: quality flags -------------------------------------------------------------
PASS = "PASS"
FAIL_PREFIX = "FAIL: "
NULL_FLAG = "FAIL: NULL {field}"
DUPLICATE_FLAG = "FAIL: DUPLICATE {field}"
INVALID_FLAG = "FAIL: INVALID {field} - {reason}"
ORPHAN_FLAG = "FAIL: ORPHAN {field}"

VERDICT_COLUMN = "quality_check_result"
CHECK_COLUMNS = {
    "completeness": "quality_completeness",
    "uniqueness": "quality_uniqueness",
    "type_validation": "quality_type_validation",
    "referential_integrity": "quality_referential_integrity",
}
OVERALL = "overall"
BUSINESS_COLUMN = "quality_business_logic"
BUSINESS_PREFIX = "FAIL_BUSINESS_LOGIC:"

# ---- fixed values: formats and accepted words ------------------------------------------------
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
MOJIBAKE_MARK = "Ã"
ORDER_STATUSES = ("completed", "pending", "cancelled")

# ---- fixed values: alert limits, as shares of 1 ----------------------------------------------
NORMAL_FROM = 0.995
WARNING_FROM = 0.99
CHECK_LIMITS = {
    "completeness": 0.99,
    "uniqueness": 0.999,
    "type_validation": 0.995,
    "referential_integrity": 0.999,
}

# ---- fixed values: customer segments, first match wins ---------------------------------------
INACTIVE_AFTER_DAYS = 180
HIGH_VALUE_ABOVE_REVENUE = 10_000
HIGH_VALUE_ABOVE_ORDERS = 20
REPEAT_FROM_ORDERS = 5
REPEAT_TO_ORDERS = 20

# ---- fixed values: value tiers (lower limit, name), highest first ----------------------------
VALUE_TIERS = ((5000, "high_value"), (500, "medium_value"))
LOWEST_TIER = "low_value"
NO_PURCHASE_TIER = "no_purchase"

# ---- fixed values: revenue buckets (upper limit, label); the last label takes the rest -------
REVENUE_BUCKETS = (
    (100, "0-100"),
    (500, "100-500"),
    (1000, "500-1000"),
    (5000, "1000-5000"),
    (10_000, "5000-10000"),
)
LAST_REVENUE_BUCKET = "10000+"
DESIGN_BUCKETS = (
    (100, "0-99"),
    (500, "100-499"),
    (1000, "500-999"),
    (5000, "1000-4999"),
)
LAST_DESIGN_BUCKET = "5000+"

# ---- fixed values: tables --------------------------------------------------------------------
DATABASE = "ecommerce"
SOURCE_FOLDER_VARIABLE = "BRONZE_DATA_PATH"
