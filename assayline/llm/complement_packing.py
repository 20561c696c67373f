"""Packing documents into as few training sequences as possible (operator 11)."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm import packing
from assayline.llm.frames import map_arrow, settled

CAPACITY = 2048
END_ID = 0

PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold the same lengths, in this order."""

    lengths: tuple[int, ...]
    count: int


class SumIndex:
    """Which lengths, and which sums of two or three of them, are still to be had.

    ``counts`` says how many pieces of each length are left. ``pairs[s]`` counts the ordered pairs of
    lengths in stock that add up to s; it changes only when a length runs out, so looking up a gap
    costs one indexed comparison for singles, pairs and triples each.
    """

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in histogram.items():
            self.counts[length] += count
        self.stock = self.counts > 0
        self.pairs = np.zeros(capacity + 1, dtype=np.int64)
        for length in np.flatnonzero(self.stock):
            self.pairs[length:] += self.stock[: capacity + 1 - length]

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for length in lengths:
            self.counts[length] -= times
        for length in set(lengths):
            if self.counts[length] == 0:
                # Both orders leave; the pair of the length with itself is one.
                self.pairs[length:] -= 2 * self.stock[: self.capacity + 1 - length]
                if 2 * length <= self.capacity:
                    self.pairs[2 * length] += 1
                self.stock[length] = False

    def enough(self, lengths: tuple[int, ...]) -> int:
        """How often the lengths, repeats included, can be taken together."""
        return min(int(self.counts[x]) // lengths.count(x) for x in set(lengths))

    def filling(self, base: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths in stock that fill the gap beside ``base`` exactly."""
        if gap <= 0:
            return None
        if self.stock[gap] and self.enough((base, gap)):
            return (gap,)
        if self.pairs[gap]:
            found = self._pair((base,), gap)
            if found:
                return found
        # A triple is a length and a pair that makes up the rest of the gap.
        firsts = np.flatnonzero(self.stock[1:gap] & (self.pairs[gap - 1 : 0 : -1] > 0)) + 1
        for first in firsts[::-1].tolist():
            if self.enough((base, first)):
                found = self._pair((base, first), gap - first)
                if found:
                    return (first, *found)
        return None

    def _pair(self, taken: tuple[int, ...], gap: int) -> tuple[int, int] | None:
        # The larger of two lengths that add up to the gap; the largest first.
        least = (gap + 1) // 2
        larger = np.flatnonzero(self.stock[least:gap] & self.stock[gap - least : 0 : -1]) + least
        for one in larger[::-1].tolist():
            if self.enough((*taken, one, gap - one)):
                return one, gap - one
        return None


def exact_complements(index: SumIndex) -> list[Pattern]:
    """Full sequences of a length and one to three others, the longest first, until none is left.

    Each round exhausts a length or leaves fewer of it than the combination takes, so there are at
    most a few rounds a length.
    """
    patterns = []
    for base in range(index.capacity, 0, -1):
        while index.counts[base]:
            found = () if base == index.capacity else index.filling(base, index.capacity - base)
            if found is None:
                break
            lengths = (base, *found)
            times = index.enough(lengths)
            index.take(lengths, times)
            patterns.append(Pattern(lengths, times))
    return patterns


def best_fit(index: SumIndex) -> list[Pattern]:
    """What is left, the longest first, each into the fullest sequence that has room.

    Sequences that hold the same lengths are one entry, so the work follows the lengths, not the
    pieces.
    """
    open_by_room: list[list[Pattern]] = [[] for _ in range(index.capacity + 1)]
    for length in range(index.capacity, 0, -1):
        while index.counts[length]:
            room = next((r for r in range(length, index.capacity) if open_by_room[r]), None)
            left = int(index.counts[length])
            if room is None:
                # A new sequence is also the fullest with room for the next piece of this length.
                each = min(index.capacity // length, left)
                lengths, times = (length,) * each, left // each
                index.take((length,), each * times)
                open_by_room[index.capacity - each * length].append(Pattern(lengths, times))
                continue
            host = open_by_room[room].pop()
            times = min(host.count, left)
            if times < host.count:
                open_by_room[room].append(Pattern(host.lengths, host.count - times))
            index.take((length,), times)
            open_by_room[room - length].append(Pattern((*host.lengths, length), times))
    return [p for patterns in open_by_room for p in patterns]


def packing_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    index = SumIndex(histogram, capacity)
    return exact_complements(index) + best_fit(index)


@dataclass
class Places:
    """Ranges of ranks by length, and where the pieces of a range go.

    ``key`` is length * 2**48 + first rank, ascending. A range deals its pieces to consecutive
    sequences, ``times`` to each.
    """

    key: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_LENGTH_SHIFT = np.int64(48)


def places(patterns: list[Pattern]) -> Places:
    rows, dealt, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length in dict.fromkeys(pattern.lengths):
            times = pattern.lengths.count(length)
            first = dealt.get(length, 0)
            dealt[length] = first + times * pattern.count
            rows.append(((length << 48) + first, times, sequence, offset))
            offset += times * length
        sequence += pattern.count
    return Places(*np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T)


def _placed(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Places = shared.value
    names = [part.split()[0] for part in PLACED.split(", ")]
    for batch in batches:
        length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
        key = (length << _LENGTH_SHIFT) + rank
        place = np.searchsorted(held.key, key, side="right") - 1
        behind, times = key - held.key[place], held.times[place]
        found = {
            "sequence_id": pa.array(held.sequence[place] + behind // times),
            "offset": pa.array(held.offset[place] + behind % times * length),
        }
        yield pa.RecordBatch.from_arrays([found[n] if n in found else batch[n] for n in names], names=names)


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Every piece of every document, with the sequence and the offset it is packed at.

    A document is its ids and ``end_id``; only a longer one than ``capacity`` is cut, into full
    pieces and a last one. A full piece is a sequence of its own, with a negative number that its
    place in the settled pieces gives, so most of a corpus of long texts is neither ranked nor
    shuffled. The other pieces are packed by their lengths alone: the histogram (fewer than
    ``capacity`` bins) goes to the driver, and the patterns come back as ranges of ranks. A piece
    finds its range by its rank among the pieces of its length, counted within (length, salt) with
    the sizes of earlier salts added. A length has as many salts as the root of its pieces, so that
    many pieces share a salt; they are dealt by place, not by value, so neither a hot length nor equal
    rows meet in one task.

    NULL and empty texts are one piece that holds the end id. NULL and repeated doc_ids and equal
    rows are documents of their own; which of two pieces of equal length comes first is settled by
    their place in the settled pieces. A text of any length is one row of the input and is cut in one
    task. An empty table gives no row; other columns are left out.
    """
    spark = docs.sparkSession
    pieces = settled(packing.cut(docs, path, capacity, end_id)).select(
        "doc_id",
        (F.col("start") / capacity).cast("int").alias("piece"),
        "start",
        "length",
        "ids_crc32",
        F.monotonically_increasing_id().alias("_place"),
    )
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row a length
    histogram = {r["length"]: r["n"] for r in lengths if r["length"] < capacity}
    held = spark.sparkContext.broadcast(places(packing_patterns(histogram, capacity)))

    whole = pieces.filter(F.col("length") == capacity).select(
        *pieces.columns[:-1], (-1 - F.col("_place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    salts = spark.createDataFrame(
        [(length, math.isqrt(n) + 1) for length, n in histogram.items()], "length long, _salts int"
    )  # fewer rows than the capacity
    salted = (
        pieces.filter(F.col("length") < capacity)
        .join(F.broadcast(salts), "length")
        .withColumn("_salt", F.pmod(F.xxhash64("_place"), F.col("_salts")).cast("int"))
    )
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("_place")
    ranked = (
        salted.withColumn("_local", F.row_number().over(within))
        .join(bases, ["length", "_salt"])
        .withColumn("_rank", F.col("_base") + F.col("_local") - 1)
        .select(*pieces.columns[:-1], "_rank")
    )
    return map_arrow(ranked, functools.partial(_placed, held), PLACED).unionByName(whole)
