"""Validity rules as boolean Columns.

Every rule is true for a valid value and false or NULL otherwise; callers treat NULL as invalid and
skip rows whose field is NULL. Casts are ``try_cast``, so text that does not parse is an invalid
value and never an error under ANSI mode.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.fixed_values import EMAIL_PATTERN

INT_MAX = 2**31 - 1
PLAIN_NUMBER = r"^\s*[+-]?\d*\.?\d*\s*$"


def _as_printed(text: Column, declared: T.DataType) -> Column:
    """The text in a type, if the type prints it as it is written; times may have a T and end in zeros."""
    value = text.try_cast(declared)
    if isinstance(declared, (T.TimestampType, T.TimestampNTZType)):
        text = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})T", "$1 ")
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    elif isinstance(declared, T.BooleanType):
        text = F.lower(text)
    return F.when(value.cast("string") == text, value)


def parsed(value: Column, landed: T.DataType, declared: T.DataType) -> Column:
    """The value in its declared type, NULL if that type cannot keep it unchanged.

    Text of a number goes through a wide decimal, so ``3.0`` is the integer 3, while ``NaN``,
    infinities, typed suffixes, numbers out of range and extra digits do not fit. Text of a day, a
    time or a truth value is parsed, printed back and compared, so ``2024``, ``2024-05`` and
    ``2024-02-03 junk`` are no days. Numbers and times of another type are cast and cast back.
    """
    exact = isinstance(declared, (T.IntegralType, T.DecimalType))
    if landed == declared:
        return value
    if isinstance(landed, T.StringType):
        text = F.trim(value)
        if exact:
            wide = text.try_cast("decimal(38,10)")
            narrow = wide.try_cast(declared)
            return F.when(narrow.cast("decimal(38,10)") == wide, narrow)
        if isinstance(declared, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
            return _as_printed(text, declared)
    narrow = value.try_cast(declared)
    timed = isinstance(declared, T.DateType) and isinstance(landed, (T.TimestampType, T.TimestampNTZType))
    if timed or (exact and isinstance(landed, T.NumericType)):
        return F.when(narrow.cast(landed) == value, narrow)
    return narrow


def as_number(field: str) -> Column:
    return F.col(field).try_cast("double")


def as_date(field: str) -> Column:
    """The day of a dated column, or of text that is written as a day is printed.

    ``typeof`` is a constant, so nothing is printed back for columns that are no text.
    """
    value = F.col(field)
    day = value.try_cast("date")
    is_text = F.typeof(value) == "string"
    return F.when(~is_text | (day.cast("string") == F.trim(value.cast("string"))), day)


def valid_email(field: str) -> Column:
    return F.col(field).cast("string").rlike(EMAIL_PATTERN)


def valid_date(field: str) -> Column:
    return as_date(field).isNotNull()


def date_not_after(field: str, as_of: date) -> Column:
    return as_date(field) <= F.lit(as_of)


def numeric(field: str) -> Column:
    return as_number(field).isNotNull()


def positive_number(field: str) -> Column:
    return as_number(field) > 0


def non_negative_number(field: str) -> Column:
    return as_number(field) >= 0


def whole_number(field: str) -> Column:
    """No fraction; text must also be a plain number within the range of an INT.

    Numeric columns of any width are accepted. ``typeof`` is a constant, so the branch that does not
    apply to the column's type is gone after constant folding.
    """
    value = as_number(field)
    is_text = F.typeof(F.col(field)) == "string"
    plain = F.col(field).cast("string").rlike(PLAIN_NUMBER) & (F.abs(value) <= INT_MAX)
    return (F.floor(value) == value) & (~is_text | plain)


def positive_integer(field: str) -> Column:
    return positive_number(field) & whole_number(field)


def non_negative_integer(field: str) -> Column:
    return non_negative_number(field) & whole_number(field)


def cost_below_price(cost: str, price: str) -> Column:
    return positive_number(cost) & (as_number(cost) < as_number(price))


def filled(field: str) -> Column:
    """Neither NULL nor blank."""
    return F.col(field).isNotNull() & (F.trim(F.col(field).cast("string")) != "")


def breaks(field: str, valid: Column) -> Column:
    """True where the field holds a value and the rule does not accept it."""
    return F.col(field).isNotNull() & ~F.coalesce(valid, F.lit(False))
