"""SimHash fingerprints and near-duplicate groups (operator 4)."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.components import components, with_table
from assayline.llm.frames import map_arrow, settled, texts

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
SEGMENTS = 3
BLOCK = 4096  # fingerprints of one bucket that a task compares with each other
_CHUNK = 1 << 16
_SMALL = 8


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    parts = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bits as a signed integer; a bit is set if it is set in over half of the shingle hashes."""
    hashes = shingle_hashes(text, words)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        rows = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t or "", words) for t in batch["text"].to_pylist()]
        rest = [batch[n] for n in batch.schema.names if n != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.int64())], names=[*names, "fingerprint"])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``fingerprint`` in place of ``text``; every other column of ``docs`` stays."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return map_arrow(docs, functools.partial(_fingerprints, words), ", ".join([*fields, "fingerprint long"]))


# ---- links -------------------------------------------------------------------------------------


def _segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of 64 bits."""
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def probe_keys(fingerprint: Column, radius: int, segments: int) -> Column:
    """The table keys under which a fingerprint is stored and looked up, as an array.

    Two fingerprints within the radius differ by at most ``radius // segments`` bits in some segment.
    Each is stored under the value of every segment and looks into the Hamming ball around it. Of two
    values that differ by an odd number of bits one has even parity, and only that one looks.
    """
    keys = []
    for number, (shift, width) in enumerate(_segments(segments)):
        value = F.shiftrightunsigned(fingerprint, shift).bitwiseAND((1 << width) - 1)
        own = value.bitwiseOR(F.lit(number << 56))
        ball = {0: [], 1: []}
        for weight in range(1, radius // segments + 1):
            for bits in combinations(range(width), weight):
                ball[weight % 2].append(own.bitwiseXOR(F.lit(sum(1 << b for b in bits))))
        odd = F.when(F.bit_count(value) % 2 == 0, F.array(*ball[1])) if ball[1] else None
        stored = F.array(own, *ball[0])
        keys.append(F.concat(stored, F.coalesce(odd, F.array().cast("array<long>"))) if ball[1] else stored)
    return F.concat(*keys)


def _near(one: np.ndarray, other: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count((one ^ other).view(np.uint64)) <= radius  # of signed numbers it counts the magnitude


def _spanning(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Verified links that connect whatever the members' links connect: one fewer than are reached."""
    links, rest = [], np.unique(members)
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            close = _near(rest, node, radius)
            for other in rest[close]:
                links.append((node, other))
                reached.append(other)
            rest = rest[~close]
    return links


def _links(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the rows of one bucket; rows arrive sorted by bucket."""

    def found(buckets: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        bounds = np.flatnonzero(np.any(buckets[1:] != buckets[:-1], axis=1)) + 1
        starts = np.concatenate([[0], bounds])
        sizes = np.diff(np.concatenate([starts, [len(prints)]]))
        small = np.repeat(sizes <= _SMALL, sizes)
        group = np.repeat(np.arange(len(starts)), sizes)
        pairs = []
        for step in range(1, int(min(_SMALL, sizes.max(initial=0)))):
            same = (group[step:] == group[:-step]) & small[step:]
            same &= _near(prints[step:], prints[:-step], radius)
            pairs.append(np.stack([prints[:-step][same], prints[step:][same]], axis=1))
        for at in np.flatnonzero(sizes > _SMALL):
            links = _spanning(prints[starts[at] : starts[at] + sizes[at]], radius)
            pairs.append(np.array(links, dtype=np.int64).reshape(-1, 2))
        every = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
        every = np.unique(np.sort(every, axis=1), axis=0)
        every = every[every[:, 0] != every[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(every[:, 0]), pa.array(every[:, 1])], names=["a", "b"])

    held = np.zeros((0, 3), np.int64)
    for batch in batches:
        rows = np.stack([batch[n].to_numpy() for n in ("_key", "_part", "fingerprint")], axis=1)
        rows = np.concatenate([held, rows])
        if not len(rows):
            continue
        last = np.flatnonzero(np.any(rows[:, :2] != rows[-1, :2], axis=1))
        cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
        held = rows[cut:]
        if cut:
            yield found(rows[:cut, :2], rows[:cut, 2])
    if len(held):
        yield found(held[:, :2], held[:, 2])


def links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Links between distinct fingerprints that connect all that differ by at most ``radius`` bits.

    Every pair within the radius meets in some bucket and is verified there over all 64 bits. Of the
    links of a bucket, those of a spanning forest are returned: the components are the same, the
    pairs of a large group are not written out. A bucket of more than ``block`` fingerprints is
    dealt in blocks, every two of which meet in a task of their own.
    """
    keyed = prints.select(
        F.explode(probe_keys(F.col("fingerprint"), radius, segments)).alias("_key"), "fingerprint"
    )
    sizes = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > block)
    sizes = sizes.withColumn("_blocks", F.ceil(F.col("_rows") / block).cast("long"))
    # Large buckets are few: one has over ``block`` of the rows.
    large = settled(sizes)
    one = keyed.withColumn("_part", F.lit(0).cast("long"))
    if not large.isEmpty():
        own = F.pmod(F.xxhash64("fingerprint"), F.col("_blocks"))
        other = F.col("_other")
        meeting = F.least(own, other) * F.col("_blocks") + F.greatest(own, other) + 1
        many = (
            keyed.join(large, "_key")
            .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
            .select("_key", "fingerprint", meeting.alias("_part"))
        )
        one = one.join(large.select("_key"), "_key", "left_anti").select("_key", "fingerprint", "_part")
        one = one.unionByName(many)
    dealt = one.repartition("_key", "_part").sortWithinPartitions("_key", "_part")
    return map_arrow(dealt, functools.partial(_links, radius), "a long, b long").distinct()


def groups(
    docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, segments: int = SEGMENTS
) -> DataFrame:
    """``fingerprint`` and ``root`` beside every column of ``docs`` but ``text``, one row per row.

    Rows belong together when a chain of fingerprints leads from one to the other, each step within
    the radius; ``root`` is the least fingerprint of the chain as a signed integer.
    """
    printed = settled(fingerprints(docs, words))
    rooted = with_table(printed, _roots(printed, radius, segments), ["fingerprint"], "left")
    return rooted.withColumn("root", F.coalesce("root", "fingerprint"))


def _roots(printed: DataFrame, radius: int, segments: int) -> DataFrame:
    """``fingerprint`` and ``root`` of every fingerprint that has a link."""
    linked = links(printed.select("fingerprint").distinct(), radius, segments)
    return components(linked).withColumnRenamed("node", "fingerprint")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, segments: int = SEGMENTS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id of the group, NULL only if no row of it has one. NULL and
    empty texts, and texts of white space, have fingerprint zero and are linked like any other. Texts
    shorter than a shingle are one shingle. Equal rows, repeated and NULL doc_ids are rows of their
    own; an empty table gives no row; other columns are left out. No text is too long.
    """
    printed = settled(fingerprints(texts(docs), words))
    # Everything about groups is settled among distinct fingerprints; rows learn of it at the end.
    own = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("_least"))
    rooted = with_table(own, _roots(printed, radius, segments), ["fingerprint"], "left")
    rooted = settled(rooted.withColumn("root", F.coalesce("root", "fingerprint")))
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = with_table(rooted.select("fingerprint", "root"), least, ["root"]).select("fingerprint", "component_id")
    return with_table(printed, named, ["fingerprint"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
