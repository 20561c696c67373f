"""Documents that hold passages of a benchmark (operator 1), in DataFrame functions alone.

A window of a document is as long as an item. It is formed where it shares enough shingles with the
item to be a match, fingerprinted by SimHash, looked up among the items' fingerprints by multi-index
Hamming blocks, and verified: the fingerprints lie within the radius and the weighted shingle
similarity reaches the threshold.

How many shingles a window shares, counted as often as both have them, is known for all windows of a
document from one sweep. The shingle at place j counts in a window from s on unless so many equal ones
lie between s and j as the item has, so it counts for one interval of s. Adding up where intervals
begin and end weighs every start once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.frames import settled, text_key, texts, unused

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 23  # of 64 bits; README states what it loses at the threshold
BLOCKS = 8  # parts of a fingerprint that are looked up
BROADCAST_ROWS = 500_000  # shingles, windows or index entries, under 100 bytes each, that are sent to every executor
ROW = ["doc_id", "_a", "_b"]


def words_of(text: str) -> Column:
    """Lower-case words between ASCII white space; NULL text has none."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\x09-\\x0D]+"))


def _shingles(words: str, size: int) -> Column:
    """All shingles of the words as texts; words fewer than a shingle are one."""
    width = F.least(F.lit(size), F.size(words))
    starts = F.sequence(F.lit(1), F.size(words) - width + 1)
    every = F.transform(starts, lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) > 0, every).otherwise(F.array().cast("array<string>"))


def _printed(df: DataFrame, shingles: str, name: str) -> DataFrame:
    """Add the fingerprint: a bit is set if it is set in over half of the shingle hashes."""
    bits = F.expr(
        "aggregate(transform(sequence(0, 63), j -> if(2 * size(filter(_hashes, h -> getbit(h, j) = 1))"
        " > size(_hashes), shiftleft(1L, j), 0L)), 0L, (a, b) -> a | b)"
    )
    hashed = df.withColumn("_hashes", F.transform(shingles, lambda s: F.xxhash64(s)))
    return hashed.withColumn(name, bits).drop("_hashes")


def _items(items: DataFrame, size: int) -> DataFrame:
    """The items with words: their number, words, words of a shingle, shingles and fingerprint."""
    worded = items.select(F.col("item_id").cast("long").alias("item_id"), words_of("text").alias("_words"))
    worded = worded.filter(F.size("_words") > 0)
    worded = worded.withColumn("length", F.size("_words"))
    worded = worded.withColumn("item", F.monotonically_increasing_id())
    worded = worded.withColumn("width", F.least(F.lit(size), "length"))
    shingled = worded.withColumn("_shingles", _shingles("_words", size)).drop("_words")
    return _printed(shingled, "_shingles", "item_print").withColumn("m", F.size("_shingles"))


def _item_shingles(items: DataFrame) -> DataFrame:
    """One row for each distinct shingle of an item, by hash, with its number of occurrences."""
    each = items.select("item", "width", "length", "m", F.explode("_shingles").alias("one"))
    return each.groupBy("item", "width", "length", "m", F.xxhash64("one").alias("hash")).agg(
        F.count(F.lit(1)).cast("int").alias("times")
    )


def _document_hash(width: int) -> Column:
    """The hash of the shingle at place ``i`` of the words of a document."""
    return F.xxhash64(F.concat_ws(" ", *[F.get("words", F.col("i") + k) for k in range(width)]))


def _worded(docs: DataFrame) -> DataFrame:
    """The words come out of a generator, so that no later filter repeats the work of splitting."""
    return docs.select("doc_id", *text_key(), F.explode(F.array(words_of("text"))).alias("words"))


def _windows(docs: DataFrame, shingles: DataFrame, widths: list[int], similarity: float, small: bool) -> DataFrame:
    """Windows whose shared shingles suffice: row, item, first word, number of words, similarity.

    Of neighbouring windows that share equally much the first stands for all.
    """
    worded = _worded(docs)
    met = []
    for width in widths:
        firsts = F.when(F.size("words") >= width, F.sequence(F.lit(0), F.size("words") - width))
        places = worded.select(*ROW, "words", F.explode(firsts).alias("i"))
        hashed = places.select(*ROW, "i", F.size("words").alias("n"), _document_hash(width).alias("hash"))
        own = shingles.filter(F.col("width") == width)
        met.append(hashed.join(F.broadcast(own) if small else own, "hash"))
    held = F.least("length", "n") - F.col("width") + 1
    marks = reduce(DataFrame.unionByName, met).withColumns({"held": held, "spare": F.greatest(F.lit(0), F.col("n") - F.col("length"))})
    pair = [*ROW, "item"]
    # Equal rows of the documents would give every place twice.
    placed = marks.repartition(*pair).groupBy(*pair, "hash", "times", "m", "held", "spare", F.least("length", "n").alias("n_words"))
    placed = placed.agg(F.sort_array(F.collect_set("i")).alias("at"))
    shifted = F.slice(F.concat(F.array_repeat(F.lit(-1), F.col("times")), "at"), 1, F.size("at"))
    each = placed.select(*pair, "m", "held", "spare", "n_words", F.inline(F.arrays_zip(F.col("at"), shifted.alias("before"))))
    each = each.toDF(*pair, "m", "held", "spare", "n_words", "at", "before")
    first = F.greatest(F.lit(0), F.col("at") - F.col("held") + 1, F.col("before") + 1)
    spans = each.withColumn("first", first).withColumn("last", F.least("at", "spare")).filter("first <= last")
    ends = F.array(
        F.struct(F.col("first").alias("start"), F.lit(1).alias("step")),
        F.struct((F.col("last") + 1).alias("start"), F.lit(-1).alias("step")),
    )
    item = ["m", "held", "spare", "n_words"]
    steps = spans.select(*pair, *item, F.inline(ends)).groupBy(*pair, *item, "start").agg(F.sum("step").alias("step"))
    sweep = Window.partitionBy(*pair).orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = steps.withColumn("shared", F.sum("step").over(sweep)).filter(F.col("start") <= F.col("spare"))
    value = F.col("shared") / (F.col("held") + F.col("m") - F.col("shared"))
    return shared.select(*pair, "start", "n_words", value.alias("similarity")).filter(F.col("similarity") >= similarity)


def _window_prints(docs: DataFrame, windows: DataFrame, words: int, broadcast_rows: int) -> DataFrame:
    """The windows with their fingerprints; the texts that have any are read again."""
    listed = windows.groupBy(*ROW).agg(F.collect_list(F.struct("item", "start", "n_words", "similarity")).alias("_found"))
    listed = listed.toDF("_id", "_a2", "_b2", "_found")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_a") == F.col("_a2")) & (F.col("_b") == F.col("_b2"))
    small = windows.count() <= broadcast_rows
    near = _worded(docs).join(F.broadcast(listed) if small else listed, same)
    near = near.select(*ROW, "words", F.inline("_found"))
    cut = F.slice("words", F.col("start") + 1, F.col("n_words"))
    columns = [*ROW, "item", "start", "n_words", "similarity"]
    cut = near.select(*columns, F.explode(F.array(cut)).alias("window"))
    shingled = cut.select(*columns, F.explode(F.array(_shingles("window", words))).alias("_shingles"))
    # Equal rows of the documents hold equal windows.
    return _printed(shingled, "_shingles", "print").drop("_shingles").dropDuplicates([*ROW, "item", "start"])


def _block(fingerprint: str, number: Column) -> Column:
    width = 64 // BLOCKS
    moved = F.call_function("shiftright", F.col(fingerprint), number * width)
    return moved.bitwiseAND(F.lit(2**width - 1)).cast("int")


def _index(items: DataFrame, radius: int) -> DataFrame:
    """Every value that a block of an item's fingerprint may have within the radius.

    Two fingerprints that differ in at most ``radius`` bits differ in at most ``radius // BLOCKS`` of
    them in some block, so that block of the one lies in the ball around that block of the other.
    """
    width = 64 // BLOCKS
    ball = F.array(*[F.lit(x) for x in range(2**width) if bin(x).count("1") <= radius // BLOCKS])
    blocks = items.select("item", "item_print", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    return blocks.select("item", "block", F.explode(ball).alias("mask"), _block("item_print", F.col("block")).alias("own")).select(
        "item", "block", F.col("own").bitwiseXOR(F.col("mask")).alias("value")
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The best window of a document for each benchmark item it holds.

    Returns ``doc_id``, ``item_id``, ``start`` (first word), ``n_words``, ``distance`` (differing
    fingerprint bits), ``similarity`` and the row key ``_a``, ``_b``. Of equally similar
    windows the first counts. Words are lower-cased; NULL and empty texts have none, items without words
    match nothing, items shorter than a shingle are one shingle and match where they occur. Repeated
    items each match. Equal rows of ``docs`` count once; rows without doc_id match like others. Empty
    tables give no row; other columns are left out. Whole texts of any length are searched.
    """
    read = texts(docs)
    listed = settled(_items(items, words))
    shingles = settled(_item_shingles(listed))
    size = shingles.agg(F.count(F.lit(1)).alias("n"), F.collect_set("width").alias("widths")).first()
    small = size["n"] <= broadcast_rows
    windows = settled(_windows(read, shingles, sorted(size["widths"]) or [words], similarity, small))
    printed = settled(_window_prints(read, windows, words, broadcast_rows))
    index = settled(_index(listed, radius))
    few = index.count() <= broadcast_rows
    blocks = printed.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    looked_up = blocks.withColumn("value", _block("print", F.col("block")))
    met = looked_up.join(F.broadcast(index) if few else index, ["item", "block", "value"]).drop("block", "value")
    targets = listed.select("item", "item_id", "item_print")
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).cast("int")
    verified = met.distinct().join(F.broadcast(targets) if few else targets, "item").withColumn("distance", distance)
    best = F.max_by(
        F.struct("start", F.col("n_words").alias("length"), "distance", "similarity"), F.struct("similarity", -F.col("start"))
    ).alias("best")
    matched = verified.filter(F.col("distance") <= radius).groupBy(*ROW, "item_id").agg(best)
    return matched.select(
        "doc_id",
        "item_id",
        F.col("best.start").cast("long").alias("start"),
        F.col("best.length").cast("long").alias("n_words"),
        F.col("best.distance").alias("distance"),
        F.col("best.similarity").alias("similarity"),
        "_a",
        "_b",
    )


def without_leaks(docs: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns, whatever their names."""
    found = leaks(docs, items, **parameters).select("doc_id", "_a", "_b").distinct()
    found = found.toDF(*unused(docs, "leak_id", "leak_a", "leak_b"))
    leak_id, leak_a, leak_b = (F.col(c) for c in found.columns)
    text = F.col("text").cast("string")
    keys = [F.xxhash64(text, text.isNull()), F.xxhash64(F.lit(7), text, text.isNull())]
    same = F.col("doc_id").cast("long").eqNullSafe(leak_id) & (keys[0] == leak_a) & (keys[1] == leak_b)
    return docs.join(found, same, "left_anti")
