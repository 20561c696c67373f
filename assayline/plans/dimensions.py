"""Each quality dimension alone: the flagged tables and their metrics.

Rows keep their landed values; keys are compared in their declared types, as Silver compares them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from assayline.operators import checks, keys, metrics
from assayline.operators.lookup import mark, settle
from assayline.specs import TABLES, TableSpec

Result = tuple[dict[str, DataFrame], DataFrame]


def completeness(bronze: Mapping[str, DataFrame], specs: Sequence[TableSpec] = TABLES) -> Result:
    """Tables with fields to check; the metrics hold one row per field."""
    checked = [spec for spec in specs if spec.completeness]
    flagged = {s.name: checks.flag_completeness(bronze[s.name], s.completeness) for s in checked}
    measured = [
        metrics.completeness_metrics(bronze[s.name], s.bronze, s.completeness) for s in checked
    ]
    return flagged, metrics.union_all(measured)


def uniqueness(bronze: Mapping[str, DataFrame], specs: Sequence[TableSpec] = TABLES) -> Result:
    """All tables, their duplicated keys settled in one job; one row of metrics per key."""
    typed = {spec.name: keys.typed_keys(bronze[spec.name], spec) for spec in specs}
    sets = [keys.beside_landed(keys.duplicate_set(spec, typed)) for spec in specs]
    flagged = {
        spec.name: mark(keys.with_typed_keys(bronze[spec.name], spec), [settled])
        .withColumn(checks.UNIQUENESS, checks.uniqueness_flag([spec.primary_key]))
        .drop(checks.DUPLICATE_MARKER)
        .transform(keys.without_typed_keys, spec)
        for spec, settled in zip(specs, settle(sets))
    }
    measured = [metrics.uniqueness_metric(typed[s.name], s.bronze, s.primary_key) for s in specs]
    return flagged, metrics.union_all(measured)


def type_validation(
    bronze: Mapping[str, DataFrame], as_of: date, specs: Sequence[TableSpec] = TABLES
) -> Result:
    """All tables; one row of metrics per rule."""
    flagged = {s.name: checks.flag_types(bronze[s.name], s.rules, as_of) for s in specs}
    measured = [metrics.rule_metrics(bronze[s.name], s.bronze, s.rules, as_of) for s in specs]
    return flagged, metrics.union_all(measured)


def referential_integrity(
    bronze: Mapping[str, DataFrame], specs: Sequence[TableSpec] = TABLES
) -> Result:
    """Tables with foreign keys; one row of metrics per foreign key."""
    children = [spec for spec in specs if spec.foreign_keys]
    typed = keys.typed_tables(bronze, children)
    sets = {spec.name: [keys.beside_landed(k) for k in keys.orphan_sets(spec, typed)] for spec in children}
    settled = iter(settle([one for spec in children for one in sets[spec.name]]))
    flagged = {}
    for spec in children:
        own = [next(settled) for _ in sets[spec.name]]
        flagged[spec.name] = (
            mark(keys.with_typed_keys(bronze[spec.name], spec), own)
            .withColumn(checks.REFERENTIAL, checks.referential_flag(spec.foreign_keys))
            .drop(*[k.marker for k in sets[spec.name]])
            .transform(keys.without_typed_keys, spec)
        )
    measured = [metrics.referential_metrics(typed[s.name], s.foreign_keys, typed) for s in children]
    return flagged, metrics.union_all(measured)
