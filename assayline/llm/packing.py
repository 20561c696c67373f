"""Packing documents into training sequences (operator 9)."""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, settled, texts
from assayline.llm.tokens import text_ids

CAPACITY = 2048
END_ID = 1
SALTS = 256  # parts into which the pieces of one length are split while they are ranked

_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, capacity: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    end = array("I", [end_id]).tobytes()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            ids = text_ids(path, text or "") + end
            total = len(ids) // 4
            for start in range(0, total, capacity):
                piece = ids[4 * start : 4 * (start + capacity)]
                rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PIECES)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document: full sequences first, then what remains."""
    return map_arrow(texts(docs), functools.partial(_cut, path, capacity, end_id), PIECES)


@dataclass
class Pattern:
    """``count`` sequences that hold the same lengths; ``parts`` are (length, times) in order."""

    parts: tuple[tuple[int, int], ...]
    count: int


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Packing patterns for a histogram of lengths, the longest placed first.

    Each length goes to the shortest pack that has room, so that packs fill evenly; only where none
    has room are new packs opened. Packs of one pattern are handled together, by count: at most one
    pattern is split for each length, so there are at most two patterns a length, and at most 63
    distinct lengths share a pack of 2048.
    """
    by_room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    roomiest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        opened: list[tuple[int, Pattern]] = []
        while left:
            while roomiest and not by_room[roomiest]:
                roomiest -= 1
            if roomiest < length or not by_room[roomiest]:
                # None of the open packs has room. Packs opened here take as many as fit evenly.
                opened.append((capacity - length, Pattern(((length, 1),), left)))
                left = 0
                break
            pack = by_room[roomiest].pop()
            moved = min(pack.count, left)
            if moved < pack.count:
                by_room[roomiest].append(Pattern(pack.parts, pack.count - moved))
            opened.append((roomiest - length, Pattern(_with(pack.parts, length), moved)))
            left -= moved
            # What was moved is open again, for the rest of this length too.
            for room, pattern in opened:
                by_room[room].append(pattern)
                roomiest = max(roomiest, room)
            opened = []
        for room, pattern in opened:
            by_room[room].append(pattern)
            roomiest = max(roomiest, room)
    return [pattern for patterns in reversed(by_room) for pattern in patterns]


def _with(parts: tuple[tuple[int, int], ...], length: int) -> tuple[tuple[int, int], ...]:
    if parts and parts[-1][0] == length:
        return (*parts[:-1], (length, parts[-1][1] + 1))
    return (*parts, (length, 1))


@dataclass
class Slots:
    """Ranges of ranks by length, and where the pieces of a range go. Sorted by (length, first rank)."""

    length: np.ndarray
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def slots(patterns: list[Pattern]) -> Slots:
    """Pieces of one length are dealt to the patterns by rank, in the order of the patterns."""
    rows, used, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, times in pattern.parts:
            first = used.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            used[length] = first + times * pattern.count
            offset += length * times
        sequence += pattern.count
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Slots(*columns)


def _assign(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Slots = shared.value
    for batch in batches:
        length = batch["length"].to_numpy()
        rank = batch["rank"].to_numpy()
        # Lengths and first ranks sort together, so the range of a piece is found by two searches.
        order = np.lexsort((rank, length))
        low = np.searchsorted(held.length, length[order], side="left")
        high = np.searchsorted(held.length, length[order], side="right")
        place = np.empty(len(order), dtype=np.int64)
        for a, b in {(int(a), int(b)) for a, b in zip(low, high)}:
            own = order[(low == a)]
            place[own] = a + np.searchsorted(held.first[a:b], rank[own], side="right") - 1
        behind = rank - held.first[place]
        sequence = held.sequence[place] + behind // held.times[place]
        offset = held.offset[place] + behind % held.times[place] * length
        names = [f.name for f in _PIECES]
        yield pa.RecordBatch.from_arrays(
            [*[batch[n] for n in names], pa.array(sequence), pa.array(offset)],
            names=[*names, "sequence_id", "offset"],
        )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document, with the sequence and the offset it is packed at.

    A document is its ids and ``end_id``. It is cut into full sequences and one rest, so each id lies
    in exactly one piece. Rests are packed by their lengths alone: the histogram (at most
    ``capacity`` bins) goes to the driver, the packing patterns come back as ranges of ranks, and a
    piece finds its sequence by its rank among the pieces of its length. Ranks are counted within
    (length, salt), with the sizes of earlier salts added, so no task ranks a whole hot length.

    NULL and empty texts are one piece that holds the end id. NULL and repeated doc_ids and equal
    rows are documents of their own. Ties in rank go by doc_id, then start, then content; equal
    pieces are interchangeable. An empty table gives no row; other columns are left out.
    """
    spark = docs.sparkSession
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(SALTS))
    pieces = settled(cut(docs, path, capacity, end_id).withColumn("_salt", salt))
    sizes = pieces.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    held = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("_local", F.row_number().over(within))
        .join(bases, ["length", "_salt"])
        .withColumn("rank", F.col("_base") + F.col("_local") - 1)
        .select(*_PIECES.names, "rank")
    )
    return map_arrow(ranked, functools.partial(_assign, held), PIECES + ", sequence_id long, offset long")
