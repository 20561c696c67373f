"""The quality checks. Each adds one column and keeps every row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import fixed_values as fixed
from assayline.functions import rules
from assayline.functions.classify import first_match
from assayline.operators.lookup import (
    KeySet,
    SizeBound,
    duplicated_keys,
    mark,
    mark_members,
    orphaned_keys,
    settle,
)
from assayline.specs import ForeignKey, Rule

COMPLETENESS = fixed.CHECK_COLUMNS["completeness"]
UNIQUENESS = fixed.CHECK_COLUMNS["uniqueness"]
TYPE_VALIDATION = fixed.CHECK_COLUMNS["type_validation"]
REFERENTIAL = fixed.CHECK_COLUMNS["referential_integrity"]

DUPLICATE_MARKER = "_duplicate"


def orphan_marker(column: str) -> str:
    return f"_orphan_{column}"


# ---- completeness ------------------------------------------------------------------------------


def completeness_flag(fields: Sequence[str]) -> Column:
    """The first NULL field, in order, names the failure; blanks count as values."""
    return first_match(
        [(F.col(f).isNull(), fixed.NULL_FLAG.format(field=f)) for f in fields], fixed.PASS
    )


def flag_completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.withColumn(COMPLETENESS, completeness_flag(fields))


def all_filled(fields: Sequence[str]) -> Column:
    """Every field holds a value that is not blank."""
    result = F.lit(True)
    for field in fields:
        result = result & rules.filled(field)
    return result


def unfilled_fields(fields: Sequence[str]) -> Column:
    """Names of the missing or blank fields, comma-separated; empty when there are none."""
    return F.concat_ws(",", *[F.when(~rules.filled(f), F.lit(f)) for f in fields])


# ---- uniqueness --------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> KeySet:
    return KeySet(DUPLICATE_MARKER, tuple(columns), duplicated_keys(df, columns))


def uniqueness_flag(columns: Sequence[str]) -> Column:
    failed = fixed.DUPLICATE_FLAG.format(field=",".join(columns))
    return F.when(F.col(DUPLICATE_MARKER), F.lit(failed)).otherwise(F.lit(fixed.PASS))


def flag_uniqueness(
    df: DataFrame, columns: Sequence[str], bound: SizeBound = SizeBound()
) -> DataFrame:
    """Every row of a key held more than once fails."""
    marked = mark_members(df, [duplicate_keys(df, columns)], bound)
    return marked.withColumn(UNIQUENESS, uniqueness_flag(columns)).drop(DUPLICATE_MARKER)


def flag_keep_first(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    bound: SizeBound = SizeBound(),
) -> DataFrame:
    """The first row of a key in the given order passes, later ones fail.

    For each duplicated key the first row is described by its values in ``order_by`` and a hash of
    the whole row. That description comes from narrow columns in two aggregates, which combine before
    the shuffle however many rows a key owns, and is settled: one row per duplicated key. The wide
    rows are then read once and compared with the first row of their key.

    Where several rows meet one description, which only copies of a row do (or rows whose hashes
    collide), those rows alone are ranked, in two rounds, so that exactly one of them passes.
    """
    duplicated = settle([duplicate_keys(df, columns)])[0]
    if duplicated.rows == 0:
        return df.withColumn(UNIQUENESS, F.lit(fixed.PASS))
    hashable = [name for name, kind in df.dtypes if "map<" not in kind]
    described = [F.col(c).alias(f"_by{i}") for i, c in enumerate(order_by)]
    described.append(F.xxhash64(*hashable).alias("_row"))
    names = [f"_by{i}" for i in range(len(order_by))] + ["_row"]

    narrow = mark(df.select(*columns, *described), [duplicated], bound).filter(DUPLICATE_MARKER)
    counted = narrow.groupBy(*columns, *names).agg(F.count(F.lit(1)).alias("_copies"))
    first = F.min(F.struct(*names, "_copies")).alias("_first")
    keys = [f"_key{i}" for i in range(len(columns))]
    winners = counted.groupBy(*columns).agg(first).toDF(*keys, "_first").checkpoint()
    width = F.sum(F.octet_length(F.to_csv(F.struct(*keys, *[f"_first.{n}" for n in names]))))
    size = winners.agg(width.alias("bytes"), F.max("_first._copies").alias("copies")).first()

    small = duplicated.rows <= bound.rows and size["bytes"] <= bound.bytes
    pairs = [(F.col(c), F.col(k)) for c, k in zip(columns, keys)]
    same_key = [a.eqNullSafe(b) if duplicated.has_null else a == b for a, b in pairs]
    dealt = df.withColumn("_salt", F.spark_partition_id()) if size["copies"] > 1 else df
    joined = dealt.select("*", *described).join(
        F.broadcast(winners) if small else winners.hint("merge"), reduce(and_, same_key), "left"
    )
    is_first = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_first.{n}")) for n in names])
    unlike = F.col("_first").isNotNull() & ~is_first
    failed = F.lit(fixed.DUPLICATE_FLAG.format(field=",".join(columns)))
    flag = F.when(unlike, failed).otherwise(F.lit(fixed.PASS))
    helpers = [*names, *keys, "_first"]
    if size["copies"] == 1:
        return joined.withColumn(UNIQUENESS, flag).drop(*helpers)
    copied = F.coalesce((F.col("_first._copies") > 1) & is_first, F.lit(False))
    ranked = _one_of_copies(joined.filter(copied), columns).withColumn(
        UNIQUENESS, F.when(F.col("_kept"), F.lit(fixed.PASS)).otherwise(failed)
    )
    single = joined.filter(~copied).withColumn(UNIQUENESS, flag)
    return single.drop(*helpers, "_salt").unionByName(ranked.drop(*helpers, "_salt", "_kept"))


def _one_of_copies(copies: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``_kept``, true for one row of each key.

    A key may own any share of the rows, so they are ranked in two rounds: within (key, ``_salt``),
    the partition they were read in, and then among the firsts alone. They are dealt out by both: a
    merge join leaves them hashed by key, and one task would rank the whole key.
    """
    own = Window.partitionBy(*columns, "_salt").orderBy(F.lit(1))
    local = copies.repartition(*columns, "_salt").withColumn("_local", F.row_number().over(own))
    # Firsts meet in group -1 of their key, the others stay in their own group.
    grouped = local.withColumn("_group", F.when(F.col("_local") == 1, -1).otherwise(F.col("_salt")))
    final = Window.partitionBy(*columns, "_group").orderBy("_local")
    ranked = grouped.withColumn("_final", F.row_number().over(final))
    kept = (F.col("_local") == 1) & (F.col("_final") == 1)
    return ranked.withColumn("_kept", kept).drop("_local", "_group", "_final")


# ---- type and format ---------------------------------------------------------------------------


def type_flag(rule_list: Sequence[Rule], as_of: date) -> Column:
    """The first broken rule, in order, names the failure; NULL fields are skipped."""
    return first_match(
        [
            (
                rules.breaks(rule.field, rule.valid(as_of)),
                fixed.INVALID_FLAG.format(field=rule.field, reason=rule.reason),
            )
            for rule in rule_list
        ],
        fixed.PASS,
    )


def flag_types(df: DataFrame, rule_list: Sequence[Rule], as_of: date) -> DataFrame:
    return df.withColumn(TYPE_VALIDATION, type_flag(rule_list, as_of))


def flag_unfitting(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the type check of rows that hold a value which its declared type cannot keep unchanged.

    Runs on the values as landed, after the rules, whose first failure stands.
    """
    lost = [
        (
            F.col(f.name).isNotNull()
            & rules.parsed(F.col(f.name), df.schema[f.name].dataType, f.dataType).isNull(),
            fixed.INVALID_FLAG.format(field=f.name, reason=f"not {f.dataType.simpleString()}"),
        )
        for f in schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    ]
    if not lost:
        return df
    own = F.col(TYPE_VALIDATION)
    return df.withColumn(
        TYPE_VALIDATION, F.when(own == fixed.PASS, first_match(lost, fixed.PASS)).otherwise(own)
    )


def add_absent_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns that the frame lacks, as NULL."""
    absent = [f for f in schema if f.name not in df.columns]
    if not absent:
        return df
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def standardize(df: DataFrame, schema: T.StructType, trim_text: bool = True) -> DataFrame:
    """Columns of the schema with their declared types, others unchanged and after them.

    Columns are matched by name; an absent one becomes NULL. Values that do not fit become NULL, so
    type rules and :func:`flag_unfitting` belong before this step.
    """
    complete = add_absent_columns(df, schema)

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name)
        actual = complete.schema[field.name].dataType
        if isinstance(actual, T.StringType) and trim_text:
            column = F.trim(column)
        if actual != field.dataType:
            column = rules.parsed(column, actual, field.dataType)
        return column.alias(field.name)

    declared = set(schema.fieldNames())
    others = [c for c in df.columns if c not in declared]
    return complete.select(*[typed(f) for f in schema], *others)


# ---- referential integrity ---------------------------------------------------------------------


def orphan_keys(
    df: DataFrame, foreign_keys: Sequence[ForeignKey], parents: Mapping[str, DataFrame]
) -> list[KeySet]:
    """One set of orphaned keys per foreign key; all parent rows count, failed ones too."""
    return [
        KeySet(
            orphan_marker(fk.column),
            (fk.column,),
            orphaned_keys(df, fk.column, parents[fk.parent], fk.parent_key),
        )
        for fk in foreign_keys
    ]


def referential_flag(foreign_keys: Sequence[ForeignKey]) -> Column:
    """The first orphaned foreign key, in order, names the failure; NULL keys are skipped."""
    return first_match(
        [
            (F.col(orphan_marker(fk.column)), fixed.ORPHAN_FLAG.format(field=fk.column))
            for fk in foreign_keys
        ],
        fixed.PASS,
    )


def referential_detail(details: Mapping[str, str], both: str = "BOTH") -> Column:
    """Which parents are missing: a text per foreign key, one text for all, NULL for none.

    Needs the markers of :func:`orphan_keys`.
    """
    markers = {column: F.col(orphan_marker(column)) for column in details}
    everything = F.lit(True)
    for marker in markers.values():
        everything = everything & marker
    return first_match(
        [(everything, both), *[(markers[c], text) for c, text in details.items()]], None
    )


def flag_referential(
    df: DataFrame,
    foreign_keys: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    bound: SizeBound = SizeBound(),
    keep_markers: bool = False,
) -> DataFrame:
    marked = mark_members(df, orphan_keys(df, foreign_keys, parents), bound)
    flagged = marked.withColumn(REFERENTIAL, referential_flag(foreign_keys))
    return flagged if keep_markers else flagged.drop(*[orphan_marker(fk.column) for fk in foreign_keys])


# ---- business rules ----------------------------------------------------------------------------


def business_flag(as_of: date, statuses: Sequence[str] = fixed.ORDER_STATUSES) -> Column:
    """PASS, or the prefix and the codes of all broken order rules; NULL fields are skipped."""

    def broken(code: str, condition: Column) -> Column:
        return F.when(condition, F.lit(code))

    def number(field: str) -> Column:
        return F.col(field).try_cast("decimal(38,6)")

    codes = F.concat_ws(
        ",",
        broken("QUANTITY", number("quantity") <= 0),
        broken("PRICE", number("unit_price") < 0),
        broken("AMOUNT", number("total_amount") < 0),
        broken("ORDER_DATE", rules.as_date("order_date") > F.lit(as_of)),
        broken("STATUS", ~F.lower(F.col("order_status")).isin(*[s.lower() for s in statuses])),
        broken(
            "AMOUNT_MISMATCH", number("total_amount") != number("quantity") * number("unit_price")
        ),
    )
    return F.when(codes == "", F.lit(fixed.PASS)).otherwise(
        F.concat(F.lit(fixed.BUSINESS_PREFIX), codes)
    )


def flag_business_rules(
    df: DataFrame, as_of: date, statuses: Sequence[str] = fixed.ORDER_STATUSES
) -> DataFrame:
    return df.withColumn(fixed.BUSINESS_COLUMN, business_flag(as_of, statuses))


# ---- verdicts ----------------------------------------------------------------------------------


def _failures(present: Sequence[str], text: Callable[[str], Column]) -> list[Column]:
    return [F.when(F.col(c) != fixed.PASS, text(c)) for c in present]


def _all_pass(present: Sequence[str]) -> Column:
    result = F.lit(True)
    for name in present:
        result = result & (F.col(name) == fixed.PASS)
    return result


def present_checks(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    return [c for c in (columns or list(fixed.CHECK_COLUMNS.values())) if c in df.columns]


def combine_flags(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """PASS when all flags pass, else the prefix and the failed flags joined by ``", "``.

    The flags keep their own prefix, so one failure reads ``FAIL: FAIL: NULL email``.
    """
    present = present_checks(df, columns)
    failures = F.concat_ws(", ", *_failures(present, F.col))
    verdict = F.when(_all_pass(present), F.lit(fixed.PASS)).otherwise(
        F.concat(F.lit(fixed.FAIL_PREFIX), failures)
    )
    return df.withColumn(fixed.VERDICT_COLUMN, verdict)


def _check_codes(df: DataFrame) -> list[tuple[str, str]]:
    return [(c, name.upper()) for name, c in fixed.CHECK_COLUMNS.items() if c in df.columns]


def composite_code(df: DataFrame) -> Column:
    """PASS, ``FAIL_<CHECK>`` for one failed check, ``FAIL_MULTIPLE:<CHECK>,...`` for several."""
    codes = dict(_check_codes(df))
    joined = F.concat_ws(",", *_failures(list(codes), lambda c: F.lit(codes[c])))
    return first_match(
        [(joined == "", fixed.PASS), (joined.contains(","), F.concat(F.lit("FAIL_MULTIPLE:"), joined))],
        F.concat(F.lit("FAIL_"), joined),
    )


def first_failure_code(df: DataFrame) -> Column:
    """PASS or ``FAIL_<CHECK>`` of the first failed check."""
    return first_match(
        [(F.col(c) != fixed.PASS, f"FAIL_{code}") for c, code in _check_codes(df)], fixed.PASS
    )


def failure_reasons(df: DataFrame) -> Column:
    """Names of the failed checks, comma-separated; NULL when all pass."""
    names = {c: name for name, c in fixed.CHECK_COLUMNS.items() if c in df.columns}
    joined = F.concat_ws(",", *_failures(list(names), lambda c: F.lit(names[c])))
    return F.nullif(joined, F.lit(""))


def passing(df: DataFrame) -> DataFrame:
    return df.filter(F.col(fixed.VERDICT_COLUMN) == fixed.PASS)


def failing(df: DataFrame) -> DataFrame:
    return df.filter(F.col(fixed.VERDICT_COLUMN) != fixed.PASS)


def failing_with(df: DataFrame, reason: str) -> DataFrame:
    """Rows whose verdict names the reason, alone or among others."""
    return df.filter(F.col(fixed.VERDICT_COLUMN).contains(reason))
