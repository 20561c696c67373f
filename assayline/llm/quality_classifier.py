"""Quality classifier over averaged word and character n-gram vectors (operator 8).

Words, their character n-grams and the fact that a word follows itself are hashed into one table of
vectors. The vectors of a document are averaged and a softmax layer gives the label; table and layer
are learned together by stochastic gradient descent on a bounded sample of labelled documents.
Scoring needs of each vector only its product with the layer, one number, so a broadcast of a
megabyte serves tables of any size, and a word costs one lookup.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, texts
from assayline.llm.quality_rules import labelled, sample

FIT_ROWS = 2000  # labelled documents that the model is trained on, at most
BUCKETS = 1 << 18
_MASK = BUCKETS - 1
DIMENSIONS = 16
EPOCHS = 10
RATE = 0.4
NGRAMS = (3,)
END = b"</s>"  # every document has it, so an empty one has a score too
SAME = b"<same>"
_WORDS_KEPT = 300_000


def bucket(feature: bytes) -> int:
    return zlib.crc32(feature) & _MASK


def word_features(word: bytes) -> list[int]:
    """Buckets of the word and of the n-grams of its characters between < and >."""
    numbers = [zlib.crc32(word) & _MASK]
    if word.isascii():
        marked, grams = b"<" + word + b">", zlib.crc32
        for n in NGRAMS:
            numbers += [grams(marked[i : i + n], 1) & _MASK for i in range(len(marked) - n + 1)]
    else:
        text = f"<{word.decode()}>"
        for n in NGRAMS:
            numbers += [zlib.crc32(text[i : i + n].encode(), 1) & _MASK for i in range(len(text) - n + 1)]
    return numbers


def _same(words: list[bytes]) -> int:
    return sum(map(bytes.__eq__, words, words[1:]))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and how often each occurs."""
    words = text.encode().split()
    counts: Counter = Counter()
    for word, times in Counter(words).items():
        for number in word_features(word):
            counts[number] += times
    counts[bucket(END)] += 1
    counts[bucket(SAME)] += _same(words)
    numbers = sorted(counts)
    return np.array(numbers, dtype=np.int32), np.array([counts[n] for n in numbers], dtype=np.int32)


@dataclass
class Classifier:
    """What scoring needs: by bucket, how much its vector speaks for label 1 rather than 0."""

    weights: np.ndarray
    bias: float
    known: dict = field(default_factory=dict, repr=False)
    values: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "known": {}, "values": []}

    def _word(self, word: bytes) -> tuple[float, int]:
        found = self.known.get(word)
        if found is None:
            numbers = word_features(word)
            self.values = self.values or self.weights.tolist()
            found = (sum(map(self.values.__getitem__, numbers)), len(numbers))
            if len(word) <= 32:
                if len(self.known) >= _WORDS_KEPT:
                    self.known.clear()
                self.known[word] = found
        return found

    def score(self, text: str) -> float:
        """The probability of label 1."""
        words = text.encode().split()
        total, number = float(self.weights[bucket(END)]), 1
        for word, times in Counter(words).items():
            weight, size = self._word(word)
            total += weight * times
            number += size * times
        same = _same(words)
        total += same * float(self.weights[bucket(SAME)])
        logit = total / (number + same) + self.bias
        return 1 / (1 + math.exp(-logit)) if logit > -700 else 0.0


def train(documents: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, seed: int = 11) -> Classifier:
    """Stochastic gradient descent over (buckets, counts) and labels; the step shrinks to zero."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    shares = [(n, (c / c.sum()).astype(np.float32)) for n, c in documents]
    steps = EPOCHS * len(shares)
    for done in range(steps):
        if done % len(shares) == 0:
            order = random.permutation(len(shares))
        rate = np.float32(RATE * (1 - done / steps))
        row = order[done % len(shares)]
        numbers, share = shares[row]
        hidden = share @ table[numbers]
        logits = layer @ hidden + bias
        error = np.exp(logits - logits.max())
        error /= error.sum()
        error[targets[row]] -= 1
        down = error @ layer
        layer -= rate * np.outer(error, hidden)
        bias -= rate * error
        # Each distinct bucket once: its share stands for all its occurrences. Scaled by their number,
        # so that rare and frequent buckets of long documents move at the pace of short ones.
        table[numbers] -= rate * np.sqrt(share)[:, None] * down
    return Classifier(table @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


# ---- frames --------------------------------------------------------------------------------------


def remainder(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "label", "numbers", "counts"]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    for batch in batches:
        rows = zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["text"].to_pylist())
        for doc_id, label, text in rows:
            numbers, counts = document_features(text or "")
            values = [[doc_id], [label], [numbers.tobytes()], [counts.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, column: str = "quality") -> Classifier:
    """A classifier trained on at most ``rows`` labelled documents outside the held-out third.

    Half of them at most have label 0, half label 1. Of rows with one doc_id one is used. Without
    documents of both labels every score is 0.5.
    """
    usable = labelled(labels, column).filter(remainder("doc_id") != 1)
    chosen = [sample(usable.filter(F.col("label") == label), rows // 2) for label in (0, 1)]
    held = texts(docs).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # bounded by ``rows``
    held = held.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    found = map_arrow(held, _features, "doc_id long, label int, numbers binary, counts binary")
    found = sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])
    targets = np.array([r[1] for r in found], dtype=np.int64)
    if len(set(targets.tolist())) < 2:
        return Classifier(np.zeros(BUCKETS, dtype=np.float32), 0.0)
    documents = [tuple(np.frombuffer(b, dtype=np.int32) for b in r[2:]) for r in found]
    return train(documents, targets)


def _score(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [shared.value.score(t or "") for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])


def scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``, one row per row of ``docs``.

    ``score`` is the probability of label 1, from the text alone. NULL and empty texts have the score
    of a document without words. A NULL doc_id is not held out; repeated doc_ids and equal rows stay
    as they are; an empty table gives no row; other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # 4 bytes a bucket
    found = map_arrow(texts(docs), functools.partial(_score, shared), "doc_id long, score double")
    return found.select(
        "doc_id",
        F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
