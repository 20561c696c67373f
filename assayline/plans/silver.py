"""Silver tables: every landed row, typed and flagged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from assayline import fixed_values as fixed
from assayline.operators import checks, keys
from assayline.operators.lookup import SizeBound, mark, settle
from assayline.specs import TABLES, TableSpec

SPECS = {spec.name: spec for spec in TABLES}


def _typed(bronze: DataFrame, spec: TableSpec, as_of: date) -> DataFrame:
    """Type rules see the values as landed; all other checks see the declared types."""
    return (
        bronze.transform(checks.add_absent_columns, spec.schema)
        .transform(checks.flag_types, spec.rules, as_of)
        .transform(checks.flag_unfitting, spec.schema)
        .transform(checks.standardize, spec.schema, False)
        .transform(checks.flag_completeness, spec.completeness)
    )


def marked_tables(
    bronze: Mapping[str, DataFrame],
    as_of: date,
    specs: Sequence[TableSpec] = TABLES,
    bound: SizeBound = SizeBound(),
    rows: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The flagged tables with their duplicate and orphan markers still in place.

    ``bronze`` holds the landed tables by name, parents included. The key sets of all tables are
    settled in one job; after it, each table is a single pass over its rows. ``rows`` may give other
    frames of the same rows for that pass, such as observed ones.
    """
    typed = keys.typed_tables(bronze, specs)
    key_sets = {s.name: [keys.duplicate_set(s, typed), *keys.orphan_sets(s, typed)] for s in specs}
    settled = iter(settle([ks for spec in specs for ks in key_sets[spec.name]]))
    marked = {}
    for spec in specs:
        own = [next(settled) for _ in key_sets[spec.name]]
        flagged = (
            mark(_typed((rows or bronze)[spec.name], spec, as_of), own, bound)
            .withColumn(checks.UNIQUENESS, checks.uniqueness_flag([spec.primary_key]))
            .withColumn(checks.REFERENTIAL, checks.referential_flag(spec.foreign_keys))
        )
        marked[spec.name] = checks.combine_flags(flagged)
    return marked


def without_markers(
    marked: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Typed columns, other landed columns, the four flags and the verdict."""
    flagged = {}
    for name, df in marked.items():
        declared = SPECS[name].schema.fieldNames()
        others = [c for c in bronze[name].columns if c not in declared]
        flagged[name] = df.select(
            *declared, *others, *fixed.CHECK_COLUMNS.values(), fixed.VERDICT_COLUMN
        )
    return flagged


def flagged_tables(
    bronze: Mapping[str, DataFrame],
    as_of: date,
    specs: Sequence[TableSpec] = TABLES,
    bound: SizeBound = SizeBound(),
) -> dict[str, DataFrame]:
    """All rows of the landed tables with their flags and verdicts."""
    return without_markers(marked_tables(bronze, as_of, specs, bound), bronze)


def quarantine_views(silver: Mapping[str, DataFrame]) -> list[str]:
    """A temporary view ``silver_<name>_quarantine`` of the failed rows of each table."""
    names = []
    for name, df in silver.items():
        view = f"silver_{name}_quarantine"
        checks.failing(df).createOrReplaceTempView(view)
        names.append(view)
    return names
