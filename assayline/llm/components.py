"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import settled


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.sum(F.xxhash64("b", "a").bitwiseAND((1 << 32) - 1)).alias("s"),
    ).first()
    return row["n"], row["x"], row["s"]


BROADCAST_ROWS = 500_000  # rows of a few numbers that are sent to every executor


def with_table(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The rows with the columns of a table that holds each key once.

    Any number of rows may share a key. A table within the bound is broadcast, so its rows stay where
    they are. A larger one is settled: with an aggregate right under the join Spark would take that
    one's partitioning and not split a hot key, while two plain shuffles let it.
    """
    table = settled(table)
    return rows.join(F.broadcast(table) if table.count() <= BROADCAST_ROWS else table, keys, how)


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Neighbours above a node are linked to the least node of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return _beside(both, least, few).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Neighbours below a node, and the node, are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = _beside(down, least, few).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _beside(links: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    """Links with the least neighbour of their node; a node may hold most of the links."""
    return links.join(F.broadcast(least), "a") if few else links.join(settled(least), "a")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with a link.

    ``links`` has columns ``a`` and ``b``. Large and small stars alternate until nothing changes;
    every round is a checkpoint, so rounds do not pile up in the lineage. Nothing but a count and
    two checksums of the links reaches the driver.
    """
    current = settled(links.select(F.col("a"), F.col("b")).filter("a <> b").distinct())
    before = _state(current)
    while before[0]:
        few = 2 * before[0] <= BROADCAST_ROWS  # no star has more rows than twice the links
        current = settled(_small_star(_large_star(current, few), few))
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
