"""Marking rows whose key belongs to a set of exceptional keys.

Duplicate and orphan checks ask the same question of every row: is its key in a set of bad keys?
The set is computed from the key columns alone with aggregates that combine before the shuffle, so a
key that holds a third of all rows leaves each map task as one row. All sets of a table are settled
in one job (a reliable checkpoint) and measured. What happens next depends on the measured size:

* empty set: the marker is a constant and the wide rows meet no join at all;
* within the size bound: a broadcast join, so the wide rows are not shuffled;
* beyond it: a sort-merge join, whose hot partitions adaptive execution splits. A key occurs once in
  the set, so only the row side is ever split and no rows multiply.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class KeySet:
    """Distinct keys, under the names of the columns they are looked up in."""

    marker: str
    columns: tuple[str, ...]
    keys: DataFrame


@dataclass(frozen=True)
class SizeBound:
    """The largest key set that is broadcast."""

    rows: int = BROADCAST_ROWS
    bytes: int = BROADCAST_BYTES


def shared_folder(spark: SparkSession) -> str:
    """The folder for reliable checkpoints and scratch tables, as named by the cluster.

    Without ``spark.checkpoint.dir`` it lies in the session's warehouse, which only a local session
    may keep on its own disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        shared = "://" in warehouse and not warehouse.startswith("file:")
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        folder = f"{warehouse.rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def duplicated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; NULL counts as a key of its own."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").drop("_rows")


def key_presence(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Each key of either side: the child rows that hold it, and whether a parent row does.

    One aggregate over the union of both key columns: it combines before the shuffle on either side,
    needs no sort, and cannot be turned into a join of uncombined rows.
    """
    key = F.col(parent_key).try_cast(child.schema[column].dataType).alias(column)
    held = child.select(column, F.lit(1).alias("_rows"), F.lit(False).alias("_known"))
    known = parent.select(key, F.lit(0).alias("_rows"), F.lit(True).alias("_known"))
    return (
        held.unionByName(known.filter(F.col(column).isNotNull()))
        .groupBy(column)
        .agg(F.sum("_rows").alias("rows"), F.bool_or("_known").alias("known"))
    )


@dataclass(frozen=True)
class Lookup:
    """A key column, and the table that should know its keys, if any."""

    column: str
    parent: DataFrame | None = None
    parent_key: str | None = None


def key_counts(child: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Rows of each key of several columns, and whether its parent knows it.

    Keys of one type share a stream of (``_set``, key), where ``_set`` is the position of the column,
    so the child is scanned once for each type among its keys, and a key crosses the shuffle as one
    narrow row per map task. The keys themselves are not kept: ``_filled`` tells whether one is not
    NULL.
    """
    by_type: dict[str, list[int]] = {}
    for i, look in enumerate(lookups):
        by_type.setdefault(child.schema[look.column].dataType.simpleString(), []).append(i)

    def stream(kind: str, positions: list[int]) -> DataFrame:
        def entry(position: int, key: Column, rows: int, known: bool) -> Column:
            return F.struct(
                F.lit(position).alias("_set"),
                key.alias("_key"),
                F.lit(rows).alias("_rows"),
                F.lit(known).alias("_known"),
            )

        entries = [entry(i, F.col(lookups[i].column), 1, False) for i in positions]
        parts = [child.select(F.inline(F.array(*entries)))]
        for i in positions:
            look = lookups[i]
            if look.parent is not None:
                key = F.col(look.parent_key).try_cast(kind)
                known = look.parent.filter(key.isNotNull()).select(entry(i, key, 0, True).alias("_entry"))
                parts.append(known.select("_entry.*"))
        return (
            reduce(DataFrame.unionByName, parts)
            .groupBy("_set", "_key")
            .agg(F.sum("_rows").alias("rows"), F.bool_or("_known").alias("known"))
            .select("_set", "rows", "known", F.col("_key").isNotNull().alias("_filled"))
        )

    return reduce(DataFrame.unionByName, [stream(kind, at) for kind, at in by_type.items()])


def orphaned_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL foreign keys of the child that no parent row holds."""
    presence = key_presence(child, column, parent, parent_key)
    return presence.filter(F.col(column).isNotNull() & ~F.col("known")).select(column)


@dataclass(frozen=True)
class SettledKeys:
    """A key set stored in the shared folder, with its measured size."""

    key_set: KeySet
    stored: DataFrame
    names: tuple[str, ...]
    rows: int
    bytes: int
    has_null: bool


def _stored_names(position: int, key_set: KeySet) -> tuple[str, ...]:
    return tuple(f"_k{position}_{c}" for c in key_set.columns)


def _tagged(position: int, key_set: KeySet) -> DataFrame:
    """The keys under names of their own, with the set, the width and the NULLs of each key."""
    columns = [F.col(c) for c in key_set.columns]
    widths = [F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) for c in columns]
    return key_set.keys.select(
        F.lit(position).alias("_set"),
        reduce(add, widths).alias("_width"),
        reduce(or_, [c.isNull() for c in columns]).alias("_null"),
        *[c.alias(name) for c, name in zip(columns, _stored_names(position, key_set))],
    )


def settle(key_sets: Sequence[KeySet]) -> list[SettledKeys]:
    """Compute all sets in one job into a reliable checkpoint, and measure each."""
    if not key_sets:
        return []
    tagged = [_tagged(i, key_set) for i, key_set in enumerate(key_sets)]
    shared_folder(tagged[0].sparkSession)
    stored = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged
    ).checkpoint()
    sizes = {
        row["_set"]: row
        for row in stored.groupBy("_set")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("_width").alias("bytes"),
            F.bool_or("_null").alias("has_null"),
        )
        .collect()  # one row per key set
    }
    settled = []
    for i, key_set in enumerate(key_sets):
        size = sizes.get(i)
        names = _stored_names(i, key_set)
        settled.append(
            SettledKeys(
                key_set,
                stored.filter(F.col("_set") == i).select(*names),
                names,
                size["rows"] if size else 0,
                size["bytes"] if size else 0,
                bool(size and size["has_null"]),
            )
        )
    return settled


def mark(
    df: DataFrame, settled: Sequence[SettledKeys], bound: SizeBound = SizeBound()
) -> DataFrame:
    """Add one boolean column per settled set: is this row's key in it? All rows are kept."""
    for keys in settled:
        marker = keys.key_set.marker
        if keys.rows == 0:
            df = df.withColumn(marker, F.lit(False))
            continue
        found = f"{marker}_found"
        members = keys.stored.withColumn(found, F.lit(True))
        small = keys.rows <= bound.rows and keys.bytes <= bound.bytes
        members = F.broadcast(members) if small else members.hint("merge")
        pairs = [(F.col(c), F.col(name)) for c, name in zip(keys.key_set.columns, keys.names)]
        # A null-safe comparison costs a wider hash key, so it is used only where a key is NULL.
        same = [a.eqNullSafe(b) if keys.has_null else a == b for a, b in pairs]
        df = (
            df.join(members, reduce(and_, same), "left")
            .withColumn(marker, F.col(found).isNotNull())
            .drop(found, *keys.names)
        )
    return df


def mark_members(
    df: DataFrame, key_sets: Sequence[KeySet], bound: SizeBound = SizeBound()
) -> DataFrame:
    """Settle the sets and mark the rows of one table."""
    return mark(df, settle(key_sets), bound)
