"""Keys in their declared types, as every check compares them.

Landed text may write one key in several ways (``1``, `` 1``, ``1.0``), so Silver, the single
dimensions and the inventory of the raw extracts all look keys up in this projection and not in the
landed values. A key that its type cannot keep is NULL here. Where a key already has its declared
type, the projection is the column itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions import rules
from assayline.operators import checks
from assayline.operators.lookup import KeySet
from assayline.specs import TABLES, TableSpec


def key_name(column: str) -> str:
    return f"_key_{column}"


def key_columns(spec: TableSpec) -> list[str]:
    """The primary key, then the foreign keys."""
    return [spec.primary_key, *[fk.column for fk in spec.foreign_keys]]


def _typed(df: DataFrame, spec: TableSpec, column: str) -> Column:
    return rules.parsed(F.col(column), df.schema[column].dataType, spec.schema[column].dataType)


def typed_keys(df: DataFrame, spec: TableSpec, columns: Sequence[str] | None = None) -> DataFrame:
    """The key columns alone; an absent one is NULL."""
    complete = checks.add_absent_columns(df, spec.schema)
    return complete.select([_typed(complete, spec, c).alias(c) for c in columns or key_columns(spec)])


def with_typed_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The landed rows with their typed keys beside them, under :func:`key_name`."""
    complete = checks.add_absent_columns(df, spec.schema)
    return df.withColumns(
        {
            key_name(c): _typed(complete, spec, c) if c in df.columns else F.lit(None).cast(spec.schema[c].dataType)
            for c in key_columns(spec)
        }
    )


def without_typed_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.drop(*[key_name(c) for c in key_columns(spec)])


def typed_tables(
    bronze: Mapping[str, DataFrame], specs: Sequence[TableSpec], known: Sequence[TableSpec] = TABLES
) -> dict[str, DataFrame]:
    """Typed keys of the given tables and of the parents that they refer to, by name."""
    by_name = {spec.name: spec for spec in [*known, *specs]}
    needed = {s.name for s in specs} | {fk.parent for s in specs for fk in s.foreign_keys}
    return {name: typed_keys(bronze[name], by_name[name]) for name in needed}


def duplicate_set(spec: TableSpec, typed: Mapping[str, DataFrame]) -> KeySet:
    return checks.duplicate_keys(typed[spec.name].select(spec.primary_key), [spec.primary_key])


def orphan_sets(spec: TableSpec, typed: Mapping[str, DataFrame]) -> list[KeySet]:
    return checks.orphan_keys(typed[spec.name], spec.foreign_keys, typed)


def beside_landed(key_set: KeySet) -> KeySet:
    """The same set, looked up in the typed keys of :func:`with_typed_keys`."""
    names = tuple(key_name(c) for c in key_set.columns)
    return KeySet(key_set.marker, names, key_set.keys.toDF(*names))
