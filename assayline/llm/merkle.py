"""A hash-tree manifest of a corpus, and proofs climbed from its leaves (operator 12)."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayline.llm.frames import settled

FAN = 8  # nodes of a run, which become one node of the next level
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_NODES = 100_000  # at most about 600 bytes each
NODES_PER_PARTITION = 50_000
TOP = "*"  # the tree over the roots of all trees; others begin with "=" or are "-"
LEVELS = 90  # below the depth that Spark lets a recursion take


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of a row: every field as its byte count, a colon and its text; NULL as a dash."""

    def stated(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[stated(f) for f in fields]), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _node_id(tree: str, level: int | Column, index: Column) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.concat(F.col(tree), F.lit("/"), level.cast("string"), F.lit("/"), index.cast("string"))


def _small(df: DataFrame) -> DataFrame:
    """A settled frame, to be broadcast if it is within the bound and merged otherwise."""
    return F.broadcast(df) if df.count() <= BROADCAST_NODES else df.hint("merge")


def _numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``_index``, the place of a row in its ``_tree``, and ``_leaves``, the rows of that tree.

    Rows are dealt by range of ``order``, which begins with ``_tree`` and tells all rows apart, and
    settled, so their partition and their place in it stay what they are. A tree of any size is thus
    spread over partitions; an index is the place in the partition plus the rows of earlier ones.
    """
    dealt = settled(df.repartitionByRange(*order).sortWithinPartitions(*order)).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")
    )
    parts = dealt.groupBy("_tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    tree = Window.partitionBy("_tree")  # one row for each partition that the tree reaches into
    earlier = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = settled(
        parts.select(
            "_tree",
            "_part",
            (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(tree).alias("_leaves"),
        )
    )
    return (
        dealt.join(_small(bases), ["_tree", "_part"])
        .withColumn("_index", F.col("_row") + F.col("_shift"))
        .drop("_part", "_row", "_shift")
    )


def _grouped(nodes: DataFrame, level: int, fan: int) -> DataFrame:
    """The nodes of the next level: ``children`` digests in order, digest, leaves beneath, width."""
    children = F.array_sort(F.collect_list(F.struct("_index", "_digest")))
    return (
        nodes.groupBy("_tree", F.expr(f"_index div {fan}").alias("_index"))
        .agg(
            F.transform(children, lambda c: c["_digest"]).alias("children"),
            F.sum("_weight").alias("_weight"),
            F.ceil(F.max("_width") / fan).alias("_width"),
        )
        .select(
            "_tree",
            F.lit(level).alias("_level"),
            "_index",
            "children",
            F.sha2(_joined(F.col("children")), 256).alias("_digest"),
            "_weight",
            "_width",
        )
    )


@dataclass
class Manifest:
    """``runs`` are the leaves in runs of ``fan``; ``nodes`` are what lies above, linked to their parents.

    A node row holds its ``id``, the digests of its ``children``, its ``parent`` and its ``place``
    among that one's children. A gate stands between the root of one tree and the tree over all of
    them; it has one child and is not hashed. The topmost node has no parent.
    """

    runs: DataFrame
    nodes: DataFrame
    root: str | None


def build(leaves: DataFrame, fan: int = FAN) -> Manifest:
    """The levels over ``leaves``: ``_tree``, ``doc_id``, ``leaf``, ``seen`` and a distinguishing ``_place``.

    Each level is one aggregate over the level below, an eighth of its rows, and is settled.
    """
    ordered = _numbered(leaves, ["_tree", "doc_id", "leaf", "seen", "_place"])
    member = F.struct("_index", "doc_id", "leaf", "seen")
    lone = F.col("_leaves") == 1
    runs = settled(
        ordered.groupBy("_tree", F.expr(f"_index div {fan}").alias("_index"))
        .agg(F.array_sort(F.collect_list(member)).alias("members"), F.max("_leaves").alias("_leaves"))
        .withColumns({"_leaf": F.transform("members", lambda m: m["leaf"]), "_weight": F.size("members").cast("long")})
        .withColumn("_digest", F.when(lone, F.col("_leaf")[0]).otherwise(F.sha2(_joined(F.col("_leaf")), 256)))
        .withColumn("_width", F.ceil(F.col("_leaves") / fan))
        .drop("_leaf")
    )
    widest = runs.agg(F.max("_width")).first()[0]
    if widest is None:
        return Manifest(runs, runs.select(F.lit("").alias("id")).limit(0), None)

    def climb_levels(level: DataFrame, width: int, number: int) -> tuple[list[DataFrame], DataFrame]:
        """All levels above the given one, and the single nodes that end their trees."""
        above, ends = [], [level.filter("_width = 1").select("_tree", "_digest", "_weight")]
        while width > 1:
            number, width = number + 1, -(-width // fan)
            level = settled(_grouped(level.filter("_width > 1"), number, fan))
            above.append(level)
            ends.append(level.filter("_width = 1").select("_tree", "_digest", "_weight"))
        return above, reduce(DataFrame.unionByName, ends)

    inner, ends = climb_levels(runs, widest, 1)
    ends = ends.select(F.lit(TOP).alias("_tree"), F.col("_tree").alias("_name"), "_digest", "_weight")
    tops = settled(_numbered(ends, ["_tree", "_name"]).withColumn("_width", F.col("_leaves")))
    trees = tops.count()
    outer, last = climb_levels(tops, trees, 0)
    root = last.first()["_digest"]

    parent = F.when(F.col("_width") > 1, _node_id("_tree", F.col("_level") + 1, F.expr(f"_index div {fan}")))
    place = F.when(F.col("_width") > 1, F.expr(f"cast(_index % {fan} as int)")).otherwise(0)
    to_gate = F.when(F.col("_tree") != TOP, F.concat(F.lit("^"), F.col("_tree")))
    linked = [
        level.select(
            _node_id("_tree", F.col("_level"), F.col("_index")).alias("id"),
            "children",
            F.coalesce(parent, to_gate).alias("parent"),
            place.alias("place"),
            F.lit(False).alias("gate"),
            F.col("_weight").alias("weight"),
        )
        for level in [*inner, *outer]
    ]
    gates = tops.withColumn("_level", F.lit(0)).select(
        F.concat(F.lit("^"), F.col("_name")).alias("id"),
        F.array("_digest").alias("children"),
        parent.alias("parent"),
        place.alias("place"),
        F.lit(True).alias("gate"),
        F.col("_weight").alias("weight"),
    )
    nodes = reduce(DataFrame.unionByName, [*linked, gates])
    rows = nodes.count()
    linked_runs = runs.withColumn("_level", F.lit(1)).select(
        _node_id("_tree", 1, F.col("_index")).alias("run"),
        "members",
        lone.alias("lone"),
        F.coalesce(parent, to_gate).alias("node"),
        place.alias("place"),
    )
    return Manifest(linked_runs, settled(nodes.repartition(rows // NODES_PER_PARTITION + 1)), root)


# A run climbs as one row: its leaves share all siblings above it, and each has its own folded digest.
_CLIMB = """
WITH RECURSIVE climb (run, node, place, light, folded, siblings, subroot) AS (
    SELECT run, node, place, light, folded, siblings, subroot FROM {start}
    UNION ALL
    SELECT /*+ %s */
        c.run,
        n.parent,
        n.place,
        n.parent_light,
        transform(c.folded, f -> if(n.gate, f, sha2(
            array_join(transform(n.children, (x, i) -> if(i = c.place, f, x)), ''), 256))),
        concat(c.siblings, unhex(array_join(filter(n.children, (x, i) -> i != c.place), ''))),
        if(n.gate, n.children[0], c.subroot)
    FROM climb c JOIN {nodes} n ON c.node = n.id AND (c.light OR %s)
)
SELECT run, node, place, light, folded, siblings, subroot FROM climb WHERE %s
"""


@contextmanager
def _unlimited_rows(spark: SparkSession):
    """Spark ends a recursion after a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    former = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        if former is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, former)


def climbed(manifest: Manifest, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """For every run its ``folded`` roots, the ``siblings`` above it in binary, and its tree's root.

    Every step of the recursion joins the runs to the nodes they have reached. All runs meet in the
    topmost nodes, so nodes with many leaves beneath are broadcast: the bound on leaves is chosen so
    that at most ``broadcast_nodes`` have as many. Where there are more nodes, a first recursion
    climbs the others by a merge join, in which no node has more than the leaves below that bound.
    """
    spark, nodes, runs = manifest.runs.sparkSession, manifest.nodes, manifest.runs
    scale = F.floor(F.log2("weight")).cast("int")
    sizes = sorted(
        ((r["s"], r["count"]) for r in nodes.groupBy(scale.alias("s")).count().collect()), reverse=True
    )  # one row for each power of two
    held, bound = 0, None
    for size, rows in sizes:
        held += rows
        if held > broadcast_nodes:
            break
        bound = size
    split = held > broadcast_nodes
    light = scale < (bound if bound is not None else 2**31 - 1)

    member_digests = F.transform(
        "members",
        lambda m, i: F.sha2(
            _joined(F.transform("members", lambda o, j: F.when(i == j, m["seen"]).otherwise(o["leaf"]))), 256
        ),
    )
    folded = F.when(F.col("lone"), F.transform("members", lambda m: m["seen"])).otherwise(member_digests)
    start = runs.select(
        "run", "node", "place", F.lit(False).alias("light"), folded.alias("folded"),
        F.expr("X''").alias("siblings"), F.lit(None).cast("string").alias("subroot"),
    )
    nodes = nodes.withColumn("parent_light", F.lit(False))

    def ascend(rows: DataFrame, over: DataFrame, hint: str, active: str, done: str) -> DataFrame:
        with _unlimited_rows(spark):
            return settled(spark.sql(_CLIMB % (hint, active, done), start=rows, nodes=over))

    if split:
        marks = nodes.select(F.col("id").alias("node"), light.alias("light"))
        start = start.drop("light").join(marks.hint("merge"), "node", "left")
        parents = marks.toDF("parent", "parent_light").hint("merge")
        nodes = settled(nodes.drop("parent_light").join(parents, "parent", "left").withColumn("light", light))
        start = ascend(start, nodes.filter("light"), "MERGE(n)", "false", "NOT coalesce(light, false)")
        start = start.withColumn("light", F.lit(False))
        nodes = nodes.filter("NOT light").withColumn("parent_light", F.lit(False))
    return ascend(start, nodes, "BROADCAST(n)", "true", "node IS NULL")


def audit(docs: DataFrame, observed: Column, fields: Sequence[str] = FIELDS, fan: int = FAN) -> DataFrame:
    """The manifest of ``docs``, and whether each row still proves itself with the ``observed`` text.

    Per row: ``doc_id``, ``leaf``, ``subroot`` of its language, ``root``, ``proof_sha256`` over the
    sibling digests from leaf to root, ``folded_root`` from the row as observed and those siblings,
    and ``verified``, whether that is the root. Texts are hashed once and not shuffled.

    NULL fields have a digest form of their own, so NULL and empty differ; a NULL lang is a tree of
    its own, in front. Rows of equal lang and doc_id, NULL doc_ids too, are ordered by digest; equal
    rows are leaves of their own. A lone row is its tree's root. Texts of any length are one hash. An
    empty table gives no row. Other columns of any name do not enter.
    """
    lang = F.col("lang").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), lang), F.lit("-")).alias("_tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_digest([F.col(f) for f in fields]).alias("leaf"),
        row_digest([observed if f == "text" else F.col(f) for f in fields]).alias("seen"),
    )
    manifest = build(settled(leaves).withColumn("_place", F.monotonically_increasing_id()), fan)
    if manifest.root is None:
        return leaves.filter("false").select(
            "doc_id", "leaf", *[F.lit("").alias(n) for n in ("subroot", "root", "proof_sha256", "folded_root")],
            F.lit(True).alias("verified"),
        )
    done = climbed(manifest).select("run", "folded", "siblings", "subroot")
    single = (
        manifest.runs.select("run", "members")
        .join(done, "run")
        .select(
            F.posexplode("members").alias("_at", "_own"),
            F.transform("members", lambda m: m["leaf"]).alias("_leaves"),
            "folded", "siblings", "subroot",
        )
    )
    others = _joined(F.filter("_leaves", lambda _, i: i != F.col("_at")))
    return single.select(
        F.col("_own.doc_id").alias("doc_id"),
        F.col("_own.leaf").alias("leaf"),
        "subroot",
        F.lit(manifest.root).alias("root"),
        F.sha2(F.concat(others, F.lower(F.hex("siblings"))), 256).alias("proof_sha256"),
        F.col("folded")[F.col("_at")].alias("folded_root"),
        (F.col("folded")[F.col("_at")] == manifest.root).alias("verified"),
    )
