"""Licence lines by Dice coefficient over word bigrams (operator 10), in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayline.llm.frames import settled, text_key, texts
from assayline.llm.license_texts import TEXTS

SIMILARITY = 0.8
CHUNK_WORDS = 512  # words of a text that one row holds, beside what windows reach beyond
BROADCAST_ROWS = 100_000  # (template, size) pairs that are sent to every executor

# Short notices by which texts name their licence.
TEMPLATES = (
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license_id string, text string")


def passages(spark: SparkSession) -> DataFrame:
    """The short notices, and the bodies, headers and SPDX lines."""
    return spark.createDataFrame([*TEMPLATES, *TEXTS], "license_id string, text string")


def normalised(text: Column) -> Column:
    """Lower-case ASCII letters and digits, everything else one space."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _bigrams(words: str) -> Column:
    """Distinct pairs of neighbours; one word alone is its own pair."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.array_join(F.slice(words, i, 2), " "))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.col(words))


def license_lines(docs: DataFrame, notices: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The most similar template of every run of lines that reaches the threshold with one.

    Returns ``doc_id``, ``line`` (first line, from 0), ``license_id`` and ``dice``, and the row key
    ``_a``, ``_b``. A template of k lines is compared with every k neighbouring lines of a document.
    Texts are normalised first; a template without words matches nothing. Sizes alone decide which
    templates a line is compared with, by an equi-join on the number of bigrams. Ties go to the
    smallest license_id. NULL and empty texts have no lines that match. Equal rows count once; rows
    without doc_id match like others; empty tables give no row; other columns are left out.
    """
    height = F.size(F.split("text", "\n"))
    listed = notices.select("license_id", height.alias("height"), F.split(normalised(F.col("text")), " ").alias("words"))
    listed = listed.filter(F.col("words") != F.array(F.lit("")))
    listed = settled(listed.select("license_id", "height", _bigrams("words").alias("notice")))
    size = F.size("notice")
    # Sizes that can reach the similarity with a template: a bounded number for each template.
    low, high = F.ceil(size * similarity / (2 - similarity) - 1e-9), F.floor(size * (2 - similarity) / similarity + 1e-9)
    sized = settled(
        listed.select("license_id", "height", "notice", F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("size"))
    )
    bounds = sized.groupBy("height").agg(F.min("size").alias("least"), F.max("size").alias("most")).collect()
    small = sized.count() <= BROADCAST_ROWS
    lined = texts(docs).select(
        "doc_id", *text_key(), F.explode(F.array(F.split(F.coalesce("text", F.lit("")), "\n"))).alias("lines")
    )
    found = None
    for height, least, most in sorted(tuple(b) for b in bounds):
        if height == 1:
            runs = lined.select("doc_id", "_a", "_b", F.posexplode("lines").alias("line", "run"))
        else:
            starts = F.when(F.size("lines") >= height, F.sequence(F.lit(0), F.size("lines") - height))
            runs = lined.select("doc_id", "_a", "_b", "lines", F.explode(starts).alias("line"))
            run = F.array_join(F.slice("lines", F.col("line") + 1, height), "\n")
            runs = runs.select("doc_id", "_a", "_b", "line", run.alias("run"))
        worded = runs.select(
            "doc_id", "_a", "_b", "line", F.explode(F.array(F.split(normalised(F.col("run")), " "))).alias("words")
        )
        # Distinct words and bigrams bound each other, so most long lines need no bigrams.
        fitting = worded.filter((F.size("words") >= least) & (F.size(F.array_distinct("words")) <= most + 1))
        pairs = fitting.select(
            "doc_id", "_a", "_b", "line", F.explode(F.array(_bigrams("words"))).alias("bigrams")
        )
        sizes = sized.filter(F.col("height") == height).drop("height")
        sizes = F.broadcast(sizes) if small else sizes
        own = pairs.filter(F.size("bigrams").between(least, most)).withColumn("size", F.size("bigrams"))
        shared = F.size(F.array_intersect("bigrams", "notice"))
        compared = own.join(sizes, "size").select(
            "doc_id", "_a", "_b", "line", "license_id", (2.0 * shared / (F.col("size") + F.size("notice"))).alias("dice")
        )
        reached = compared.filter(F.col("dice") >= similarity)
        found = reached if found is None else found.unionByName(reached)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, line long, license_id string, dice double, _a long, _b long")
    best = F.min(F.struct((-F.col("dice")).alias("less"), "license_id")).alias("best")
    return (
        found.groupBy("doc_id", "_a", "_b", "line")
        .agg(best)
        .select(
            "doc_id",
            F.col("line").cast("long").alias("line"),
            F.col("best.license_id").alias("license_id"),
            (-F.col("best.less")).alias("dice"),
            "_a",
            "_b",
        )
    )


def _chunks(docs: DataFrame, reach: int) -> DataFrame:
    """Texts in parts of ``CHUNK_WORDS`` words, with as many words before and behind as a window reaches.

    ``part`` holds words and their lines from word ``off`` of the text on, ``base`` is the first word
    of the part's own, ``n`` counts the words of the text. No row holds more than a part.
    """
    read = texts(docs).select("doc_id", *text_key(), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    worded = F.transform(
        "lines",
        lambda line, number: F.transform(
            F.filter(F.split(normalised(line), " "), lambda w: w != ""),
            lambda w: F.struct(w.alias("word"), number.cast("int").alias("line")),
        ),
    )
    # The words come out of a generator, so that no later filter repeats the work of splitting.
    held = read.select("doc_id", "_a", "_b", F.explode(F.array(F.flatten(worded))).alias("held"))
    firsts = F.when(F.size("held") > 1, F.sequence(F.lit(0), F.size("held") - 2, F.lit(CHUNK_WORDS)))
    based = held.select("doc_id", "_a", "_b", "held", F.size("held").alias("n"), F.explode(firsts).alias("base"))
    off = F.greatest(F.lit(0), F.col("base") - reach)
    part = F.slice("held", off + 1, F.col("base") - off + CHUNK_WORDS + reach)
    return based.select("doc_id", "_a", "_b", "n", "base", off.alias("off"), F.explode(F.array(part)).alias("part"))


def _without_overlaps(windows: DataFrame, row: list[str]) -> DataFrame:
    """Of windows ``one`` that overlap within a row the least, by the order of its fields, again and again.

    A row's windows are cut where none reaches on, and each stretch takes them best first, leaving
    out what overlaps one taken before.
    """
    placed = Window.partitionBy(*row).orderBy("one.start")
    reached = F.max("one.behind").over(placed.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("one.start") < reached, 0).otherwise(1)
    cut = windows.distinct().withColumn("_apart", apart)
    cut = cut.withColumn("_stretch", F.sum("_apart").over(placed.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = cut.groupBy(*row, "_stretch").agg(F.sort_array(F.collect_list("one")).alias("every"))
    taken = F.aggregate(
        "every",
        F.slice("every", 1, 0),
        lambda held, w: F.when(
            F.exists(held, lambda o: (o["start"] < w["behind"]) & (w["start"] < o["behind"])), held
        ).otherwise(F.concat(held, F.array(w))),
    )
    return stretches.select(*row, F.explode(taken).alias("one"))


def license_passages(
    docs: DataFrame, notices: DataFrame, similarity: float = SIMILARITY, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The passages of a text that reach the threshold with a template, wherever they stand.

    Returns the columns of ``license_lines`` with ``line`` of the first word, and ``last``, the line of
    the last. A text is normalised as a whole; a template of k words is compared with windows of k
    words. To reach the similarity t a window must share t / (2 - t) of the template's m bigrams, so
    windows are formed only around the longest bigrams, one more than may be missing, and weighed by
    the places at which they have any. Windows are taken best first, by similarity, then length,
    license_id and place, and one that overlaps another already taken is left out. NULL and empty
    texts, and texts shorter than a template, have no window. A text of any length is searched in
    parts that overlap by the longest template, so no row grows with the text. Equal rows count once;
    rows without doc_id match like others.
    """
    row = ["doc_id", "_a", "_b"]
    listed = notices.select("license_id", F.split(normalised(F.col("text")), " ").alias("words"))
    listed = listed.filter(F.size("words") > 1).withColumn("length", F.size("words"))
    listed = listed.select("license_id", "length", _bigrams("words").alias("notice")).distinct()
    listed = settled(
        listed.withColumn("item", F.monotonically_increasing_id())
        .withColumn("needed", F.ceil(F.size("notice") * similarity / (2 - similarity) - 1e-9).cast("int"))
    )
    # The longer a bigram, the fewer texts hold it.
    ranked = F.sort_array(F.transform("notice", lambda p: F.struct((-F.length(p)).alias("rank"), p.alias("pair"))))
    chosen = F.slice(ranked, 1, F.size("notice") - F.col("needed") + 1)
    lookups = listed.select("item", "length", F.explode(chosen).alias("one"))
    lookups = settled(lookups.select("item", F.col("length").alias("least"), F.xxhash64("one.pair").alias("hash")))
    small = lookups.count() <= broadcast_rows
    reach = listed.agg(F.max("length")).first()[0] or 0
    chunks = _chunks(docs, reach)
    own = F.sequence(F.lit(0), F.least(F.lit(CHUNK_WORDS), F.col("n") - 1 - F.col("base")) - 1)
    places = chunks.select(*row, "n", "base", "off", "part", F.explode(own).alias("i"))
    at = F.col("base") - F.col("off") + F.col("i")
    pair = F.concat_ws(" ", F.get("part", at)["word"], F.get("part", at + 1)["word"])
    held = [*row, "n", "base", "off", "part"] if small else [*row, "n", "base"]
    hashed = places.select(*held, (F.col("base") + F.col("i")).alias("i"), F.xxhash64(pair).alias("hash"))
    hits = hashed.join(F.broadcast(lookups) if small else lookups, "hash").filter(F.col("n") >= F.col("least"))
    hits = hits.drop("hash", "least")
    if not small:
        hits = hits.groupBy(*row, "base").agg(F.collect_set(F.struct("item", "i")).alias("_hits"))
        hits = hits.toDF("_id", "_a2", "_b2", "_base2", "_hits")
        same = (
            F.col("doc_id").eqNullSafe(F.col("_id"))
            & (F.col("_a") == F.col("_a2"))
            & (F.col("_b") == F.col("_b2"))
            & (F.col("base") == F.col("_base2"))
        )
        hits = chunks.join(hits, same).select(*row, "n", "base", "off", "part", F.inline("_hits"))
    hits = hits.join(F.broadcast(listed) if small else listed, "item")
    # All windows that contain the bigram: their first words, and the bigrams that they cover.
    hits = hits.withColumn("low", F.greatest(F.lit(0), F.col("i") + 2 - F.col("length")))
    hits = hits.withColumn("high", F.least("i", F.col("n") - F.col("length")))
    span = F.slice("part", F.col("low") - F.col("off") + 1, F.col("high") - F.col("low") + F.col("length"))
    names = [*row, "license_id", "length", "notice", "needed", "low"]
    hits = hits.select(*names, (F.col("high") - F.col("low")).alias("more"), F.explode(F.array(span)).alias("span"))
    covered = F.transform(
        F.sequence(F.lit(0), F.col("more") + F.col("length") - 2),
        lambda j: F.concat_ws(" ", F.get("span", j)["word"], F.get("span", j + 1)["word"]),
    )
    hits = hits.select(*names, "more", F.col("span.line").alias("lines"), F.explode(F.array(covered)).alias("pairs"))
    # Marks before each place, so that every first word is weighed by one subtraction.
    counted = F.aggregate(
        F.transform("pairs", lambda p: F.array_contains("notice", p).cast("int")),
        F.array(F.lit(0)),
        lambda sums, mark: F.concat(sums, F.array(F.element_at(sums, -1) + mark)),
    )
    hits = hits.select(*names, "more", "lines", "pairs", F.explode(F.array(counted)).alias("marks"))
    tried = F.filter(
        F.sequence(F.lit(0), F.col("more")),
        lambda s: F.get("marks", s + F.col("length") - 1) - F.get("marks", s) >= F.col("needed"),
    )
    windows = hits.select(*names, "lines", "pairs", F.explode(tried).alias("at"))
    own = F.array_distinct(F.slice("pairs", F.col("at") + 1, F.col("length") - 1))
    windows = windows.select(*names, "lines", "at", F.explode(F.array(own)).alias("own"))
    dice = 2.0 * F.size(F.array_intersect("own", "notice")) / (F.size("own") + F.size("notice"))
    windows = windows.withColumn("dice", dice).filter(F.col("dice") >= similarity)
    start = F.col("low") + F.col("at")
    one = F.struct(
        (-F.col("dice")).alias("less"),
        (-F.col("length")).alias("shorter"),
        "license_id",
        start.alias("start"),
        (start + F.col("length")).alias("behind"),
        F.get("lines", F.col("at")).cast("long").alias("line"),
        F.get("lines", F.col("at") + F.col("length") - 1).cast("long").alias("last"),
    ).alias("one")
    return _without_overlaps(windows.select(*row, one), row).select(
        "doc_id",
        F.col("one.line").alias("line"),
        F.col("one.license_id").alias("license_id"),
        (-F.col("one.less")).alias("dice"),
        "_a",
        "_b",
        F.col("one.last").alias("last"),
    )


def license_notices(
    docs: DataFrame, lines: DataFrame, passages: DataFrame, similarity: float = SIMILARITY
) -> DataFrame:
    """``license_lines`` with the templates ``lines``, and ``license_passages`` with ``passages`` beside them.

    A passage inside a line that matched as a whole, or that names the same licence from the same
    line on, is not listed again. A line may hold passages of several licences.
    """
    whole = license_lines(docs, lines, similarity)
    known = whole.select(*[F.col(c).alias(f"_{c}_") for c in ("doc_id", "_a", "_b", "line", "license_id")])
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id_"))
        & (F.col("_a") == F.col("__a_"))
        & (F.col("_b") == F.col("__b_"))
        & (F.col("line") == F.col("_line_"))
        & ((F.col("license_id") == F.col("_license_id_")) | (F.col("last") == F.col("line")))
    )
    more = license_passages(docs, passages, similarity).join(known, same, "left_anti").drop("last")
    # Of a licence that a line holds twice, the more similar passage.
    more = more.groupBy("doc_id", "_a", "_b", "line", "license_id").agg(F.max("dice").alias("dice"))
    return whole.unionByName(more)
