"""Token counts of every prefix of a text (operator 6)."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, texts
from assayline.llm.tokens import runs, word_tokenizer

BATCH_CHARS = 2_000_000
SCHEMA = "doc_id long, text string, prefix_tokens array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("prefix_tokens", pa.list_(pa.int32()))])


def prefix_table(path: str, text: str) -> np.ndarray:
    """Element k is the number of tokens of the first k code points."""
    words = runs(text)
    if not words:
        return np.zeros(len(text) + 1, dtype=np.int32)
    counts = np.frombuffer(b"".join(map(word_tokenizer(path).run_counts.__getitem__, words)), dtype=np.int32)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    totals = counts[np.cumsum(lengths) - 1].astype(np.int64)
    known = np.concatenate([[0], counts + np.repeat(np.cumsum(totals) - totals, lengths)]).astype(np.int32)
    # A prefix that ends in white space has the tokens of what stands before it.
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return known[np.concatenate([[0], np.cumsum(~_white(points))])]


_WHITE_POINTS = np.array(
    [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    dtype=np.uint32,
)
_LOW_WHITE = np.isin(np.arange(0x3001, dtype=np.uint32), _WHITE_POINTS)


def _white(points: np.ndarray) -> np.ndarray:
    return _LOW_WHITE[np.minimum(points, 0x2FFF)] | (points == 0x3000)


def _tables(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(ids, values, tables):
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tables])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tables)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.string()), lists], schema=_ARROW)

    for batch in batches:
        ids, values, tables, size = [], [], [], 0
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            ids.append(doc_id)
            values.append(text)
            tables.append(prefix_table(path, text or ""))
            size += len(tables[-1])
            if size >= BATCH_CHARS:
                yield emit(ids, values, tables)
                ids, values, tables, size = [], [], [], 0
        if ids:
            yield emit(ids, values, tables)


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` and ``prefix_tokens``, one row per row of ``docs``.

    ``prefix_tokens[k]`` is the exact number of tokens of the first k code points, k from 0 to the
    length of the text. Within a word the counts come from dynamic programming over its prefixes,
    across words they add up. NULL text counts as empty: one element, 0. NULL and repeated doc_ids,
    and equal rows, are kept as they are; other columns are left out. A text of any length is one
    row; the work per text is proportional to its length, but for runs that are not in composed form
    (NFC), where it is quadratic in the length of the run.
    """
    return map_arrow(texts(docs), functools.partial(_tables, path), SCHEMA)


ANSWERS = "doc_id long, n_bytes long, n_tokens long, fitting_chars long"
_ANSWERS_ARROW = pa.schema([(part.split()[0], pa.int64()) for part in ANSWERS.split(", ")])


def _answers(path: str, budget: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, fitting = [], []
        for text in batch["text"].to_pylist():
            known = prefix_table(path, text or "")
            totals.append(int(known[-1]))
            fitting.append(int(np.flatnonzero(known <= budget)[-1]) if known[-1] > budget else len(known) - 1)
        n_bytes = pc.fill_null(pc.binary_length(batch["text"]), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], n_bytes, pa.array(totals, pa.int64()), pa.array(fitting, pa.int64())], schema=_ANSWERS_ARROW
        )


def budget_answers(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """What the prefix counts of a text say of a budget, without handing out the counts themselves.

    ``n_bytes`` of the text in UTF-8, ``n_tokens`` of all of it, and ``fitting_chars``, the most leading
    code points that have at most ``budget`` tokens. Rows as in :func:`prefix_counts`.
    """
    return map_arrow(texts(docs), functools.partial(_answers, path, budget), ANSWERS)


def tokens_total(prefix_tokens: str) -> Column:
    return F.element_at(prefix_tokens, -1).cast("long")


def tokens_of_prefix(prefix_tokens: str, length: Column) -> Column:
    """Tokens of the first ``length`` code points; of the whole text if it is shorter."""
    return F.element_at(prefix_tokens, F.least(length, F.size(prefix_tokens) - 1).cast("int") + 1)


def longest_prefix(prefix_tokens: str, budget: int) -> Column:
    """The largest number of leading code points with at most ``budget`` tokens."""
    fits = F.transform(prefix_tokens, lambda c, k: F.when(c <= budget, k))
    return F.array_max(fits)
