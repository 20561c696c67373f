"""Removal of word windows that an earlier document holds too (operator 2).

A window is counted only if some other text can hold it. Equal windows contain equal shorter
windows, so the least hash among the anchors (16-word windows) of a 50-word window is the same
wherever the window occurs. Texts first exchange these least anchors, one for about every 18 words;
windows whose anchor occurs in one text alone cannot repeat elsewhere and are not shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, settled, texts

WINDOW = 50
ANCHOR = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORDS_KEPT = 400_000
_CHUNK = 1 << 18


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= _WORDS_KEPT:
                self.clear()
            self[word] = value
        return value


_WORD_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    values = np.full(count, base, dtype=np.uint64)
    values[:1] = 1
    return np.cumprod(values)


def rabin_karp(hashes: np.ndarray, width: int) -> np.ndarray:
    """The polynomial hash of every window of ``width`` words, modulo 2**64, bits mixed."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(hashes)))])
    rolled = (sums[width:] - sums[:-width]) * _powers(_INVERSE, count)
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    return rolled ^ (rolled >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _hashed(text: str, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window of a text: its hash, and the least hash of the anchors in it."""
    hashes = word_hashes(text.encode().split())
    if len(hashes) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return rabin_karp(hashes, window), sliding_least(rabin_karp(hashes, anchor), window - anchor + 1)


def _anchors(window: int, anchor: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.unique(_hashed(t, window, anchor)[1]).view(np.int64) for t in batch["text"].to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        values = np.concatenate([np.zeros(0, np.int64), *found])
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        yield pa.RecordBatch.from_arrays([batch["_key"], batch["doc_id"], lists], names=["_key", "doc_id", "anchors"])


def _windows(window: int, anchor: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows whose anchor is among the shared ones of the text."""
    names = ["doc_id", "_copy", "anchor", "hash", "start"]
    for batch in batches:
        copies, ids = batch["_copy"].to_pylist(), batch["doc_id"].to_pylist()
        for row, text in enumerate(batch["text"].to_pylist()):
            hashes, least = _hashed(text, window, anchor)
            shared = np.array(batch["shared"][row].as_py() or [], dtype=np.int64).view(np.uint64)
            starts = np.flatnonzero(np.isin(least, shared))
            for at in range(0, len(starts), _CHUNK):
                some = starts[at : at + _CHUNK]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), ids[row], np.int64)),
                        pa.array(np.full(len(some), copies[row], np.int32)),
                        pa.array(least[some].view(np.int64)),
                        pa.array(hashes[some].view(np.int64)),
                        pa.array(some.astype(np.int32)),
                    ],
                    names=names,
                )


def _intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of words that the windows cover, as (first word, word behind the last)."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    gaps = np.flatnonzero(np.diff(starts) > window)
    firsts = starts[np.concatenate([[0], gaps + 1])]
    lasts = starts[np.concatenate([gaps, [len(starts) - 1]])]
    return [(int(a), int(b) + window) for a, b in zip(firsts, lasts)]


_KEPT = "doc_id long, kept_text string, n_words long, n_removed long, removed array<struct<first:int,behind:int>>"
_KEPT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("kept_text", pa.string()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32())]))),
    ]
)


def _removed(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        owners, ids = batch["owner"].to_pylist(), batch["doc_id"].to_pylist()
        for row, text in enumerate(batch["text"].to_pylist()):
            words = text.encode().split()
            if ids[row] is None:
                cut = []
            elif owners[row] < ids[row]:  # a smaller document is this very text
                cut = [(0, len(words))] if len(words) >= window else []
            else:
                cut = _intervals(np.array(batch["starts"][row].as_py() or [], dtype=np.int64), window)
            kept, at = [], 0
            for first, behind in cut:
                kept.extend(words[at:first])
                at = behind
            kept.extend(words[at:])
            rows.append((b" ".join(kept).decode(), len(words), len(words) - len(kept), [{"first": a, "behind": b} for a, b in cut]))
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *[pa.array(c, t.type) for c, t in zip(columns, list(_KEPT_ARROW)[1:])]],
            schema=_KEPT_ARROW,
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Each row of ``docs`` without the words of windows that start in a smaller doc_id too.

    Returns ``doc_id``, ``kept_text`` (kept words joined by one space), ``n_words``,
    ``n_removed`` and ``removed`` (maximal intervals of removed words). Windows are judged on the
    input. NULL text has no words. A row without doc_id loses nothing and takes nothing from others.
    Rows of one doc_id do not remove from each other; equal rows are each returned. Texts shorter
    than the window are kept. An empty table gives no row; other columns are left out.

    Rows of one text share the work: its smallest doc_id stands for all, and larger ones with at
    least ``window`` words keep nothing. Keys are 128 bits of SHA-256 for texts, and for windows the
    64-bit hash together with that of their anchor.
    """
    filled = F.coalesce("text", F.lit(""))
    keyed = texts(docs).select(
        "doc_id",
        filled.alias("text"),
        F.substring(F.unhex(F.sha2(filled, 256)), 1, 16).alias("_key"),
    )
    read = keyed.filter("doc_id is not null")
    found = settled(
        map_arrow(read, functools.partial(_anchors, window, anchor), "_key binary, doc_id long, anchors array<long>")
    )
    # Each text once, for the smallest doc_id that has it. That id and the place of the text among the
    # texts of the id name it from here on: small numbers, unlike the key, shuffle in few bytes.
    single = found.groupBy("_key").agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors"))
    named = settled(
        single.withColumn("_copy", F.row_number().over(Window.partitionBy("doc_id").orderBy("_key")))
    )
    anchors = named.select("doc_id", "_copy", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("anchor")
    wanted = anchors.join(shared, "anchor").groupBy("doc_id", "_copy").agg(F.collect_set("anchor").alias("shared"))
    names = named.select("doc_id", "_copy", "_key")
    wanted = names.join(wanted, ["doc_id", "_copy"])
    # Texts are dealt out by (doc_id, _key) twice, with the same columns, so that one shuffle serves both.
    windows = map_arrow(
        read.join(wanted, ["doc_id", "_key"]),
        functools.partial(_windows, window, anchor),
        "doc_id long, _copy int, anchor long, hash long, start int",
    )
    first = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("_last_id"))
    first = first.filter("first_id < _last_id").select("anchor", "hash", "first_id")
    repeated = windows.join(first, ["anchor", "hash"]).filter("first_id < doc_id")
    starts = repeated.groupBy("doc_id", "_copy").agg(F.collect_set("start").alias("starts"))
    starts = names.join(starts, ["doc_id", "_copy"]).select("doc_id", "_key", "starts")
    owners = names.select("_key", F.col("doc_id").alias("owner"))
    rulings = found.select("doc_id", "_key").distinct().join(owners, "_key").join(starts, ["doc_id", "_key"], "left")
    ruled = read.join(rulings, ["doc_id", "_key"]).select("doc_id", "text", "owner", "starts")
    unnamed = keyed.filter("doc_id is null").selectExpr(
        "doc_id", "text", "cast(null as long) as owner", "cast(null as array<int>) as starts"
    )
    return map_arrow(ruled.unionByName(unnamed), functools.partial(_removed, window), _KEPT)
