"""Quality rules: rule statistics, judged by an isolation forest (operator 7)."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, settled, texts

FIT_ROWS = 6000  # labelled rows that the forests are grown on, at most; thresholds see all of them
LABELS_BROADCAST = 1_000_000  # labelled ids of 12 bytes that are sent to every executor
TREES = 100
SUBSAMPLE = 256
CLEAN_LOSS = 0.001  # share of the rows labelled good that a threshold may reject
TELLING = 20  # times as many of the bad rows must lie above a threshold that good rows pay for
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(0x41, 0x5B))

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclamations")
#: A forest sees the features of one group. Each has a threshold of its own.
GROUPS = (("symbol_share",), ("upper_share", "exclamations"), ("dup_line_share", "repeat_share"), ("word_length",))


def _repeated_words(words: list[bytes]) -> tuple[int, int]:
    """(words covered by 3-word windows that occur more than once, distinct words)."""
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(codes) < 3:
        return 0, len(numbers)
    size = len(numbers)
    pairs = codes[:-2] * size + codes[1:-1]
    if size > 1 << 20:  # three numbers of 20 bits fit into one of 63
        known, pairs = np.unique(pairs, return_inverse=True)
        size = max(size, len(known))
    keys = pairs * size + codes[2:] if size <= 1 << 20 else None
    if keys is None:
        _, keys = np.unique(np.stack([pairs, codes[2:]]), axis=1, return_inverse=True)
    _, places, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = counts[places] >= 2
    covered = np.zeros(len(codes), dtype=bool)
    for step in range(3):
        covered[step : len(codes) - 2 + step] |= twice
    return int(covered.sum()), size


def _share(count: float, total: float) -> float:
    return count / total if total else 0.0


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The rule statistics of a text, and the features that the forest sees."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
    letters = len(text) - sum(data.count(c) for c in _SPACE)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    duplicates = len(lines) - len(set(lines))
    repeated, _ = _repeated_words(words)
    counts = (len(words), letters, symbols, duplicates, repeated)
    features = (
        _share(letters, len(words)),
        _share(symbols, letters),
        _share(duplicates, len(lines)),
        _share(repeated, len(words)),
        _share(len(data) - len(data.translate(None, _UPPER)), letters),
        _share(data.count(b"!"), len(words)),
    )
    return counts, features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > 50 * n_words


# ---- isolation forest ----------------------------------------------------------------------------


def average_path(size: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``size`` points."""
    size = np.asarray(size, dtype=float)
    safe = np.maximum(size, 2)
    harmonic = np.log(safe - 1) + np.euler_gamma
    path = 2 * harmonic - 2 * (safe - 1) / safe
    return np.where(size > 2, path, np.where(size == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as arrays: node k of a tree has children 2k + 1 and 2k + 2; leaves have feature -1."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    expected: float

    @classmethod
    def fit(cls, points: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> IsolationForest:
        random = np.random.default_rng(seed)
        size = min(subsample, len(points))
        depth = max(1, math.ceil(math.log2(max(size, 2))))
        nodes = 2 ** (depth + 1) - 1
        feature = np.full((trees, nodes), -1, dtype=np.int16)
        split = np.zeros((trees, nodes))
        path = np.zeros((trees, nodes))
        for tree in range(trees):
            chosen = points[random.choice(len(points), size, replace=False)]
            pending = [(0, 0, chosen)]
            while pending:
                node, level, rows = pending.pop()
                spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
                if level == depth or not len(spread):
                    path[tree, node] = level + average_path(len(rows))
                    continue
                column = random.choice(spread)
                at = random.uniform(rows[:, column].min(), rows[:, column].max())
                below = rows[:, column] <= at
                feature[tree, node], split[tree, node] = column, at
                pending += [(2 * node + 1, level + 1, rows[below]), (2 * node + 2, level + 1, rows[~below])]
        return cls(feature, split, path, float(average_path(size)) or 1.0)

    def anomaly(self, points: np.ndarray) -> np.ndarray:
        """0 to 1 for each point; the shorter its paths, the nearer to 1."""
        total = np.zeros(len(points))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.zeros(len(points), dtype=np.int64)
            active = np.flatnonzero(feature[node] >= 0)
            while len(active):
                at = node[active]
                above = points[active, feature[at]] > split[at]
                node[active] = 2 * at + 1 + above
                active = active[feature[node[active]] >= 0]
            total += path[node]
        return 2.0 ** (-total / len(self.path) / self.expected)


@dataclass
class Judge:
    """Fitted forests with the columns they see, and the scores above which a document is rejected."""

    forests: list[tuple[list[int], IsolationForest, float]]

    def verdicts(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest anomaly of each row, and whether one lies above its threshold."""
        highest, rejected = np.zeros(len(features)), np.zeros(len(features), dtype=bool)
        for columns, forest, threshold in self.forests if len(features) else []:
            scores = forest.anomaly(features[:, columns])
            highest, rejected = np.maximum(highest, scores), rejected | (scores > threshold)
        return highest, rejected


@dataclass
class Above:
    """What labelled rows say of a score: the good row that may be lost, the highest good row, and bad rows above."""

    allowed: float
    highest_good: float
    bad: int
    bad_above_allowed: int
    least_bad_above_allowed: float | None
    least_bad_above_good: float | None

    def threshold(self, loss: float, telling: float = TELLING) -> float:
        """Where a document is too unlike the good ones.

        If far more bad rows than the share ``loss`` lie above the good row that may be lost, the
        threshold is there. If not, it lies beyond every good row, so junk of a rare kind is rejected
        and no good row pays for it. Either way it is halfway to the next bad row, so that good rows
        unlike the labelled ones are kept. Where no bad row lies above, nothing is rejected.
        """
        if self.bad_above_allowed > telling * loss * self.bad:
            return (self.allowed + self.least_bad_above_allowed) / 2
        if self.least_bad_above_good is not None:
            return (self.highest_good + self.least_bad_above_good) / 2
        return 1.0


# ---- frames --------------------------------------------------------------------------------------


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[*counts, *features] for counts, features in (statistics(t or "") for t in batch["text"].to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["label"], pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "row"]
        )


def labelled(labels: DataFrame, column: str = "quality") -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1), one row per doc_id; ids labelled both ways are left out."""
    read = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    read = read.filter("doc_id is not null and label in (0, 1)")
    both = read.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
    return both.filter("label = _most").select("doc_id", "label")


def sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the first by a hash of the id."""
    return labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _anomalies(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array(batch["row"].to_pylist(), dtype=float).reshape(-1, len(STATISTICS) + len(FEATURES))
        points = rows[:, len(STATISTICS) :]
        scores = np.stack([forest.anomaly(points[:, columns]) for columns, forest in shared.value], axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch["label"], pa.array(scores.tolist(), pa.list_(pa.float64()))], names=["label", "scores"]
        )


def _above(scored: DataFrame, groups: int, loss: float) -> list[Above] | None:
    """The exact order statistics of all labelled rows, for the score of each group."""
    score = [F.col("scores")[i] for i in range(groups)]
    good, bad = F.col("label") == 1, F.col("label") == 0
    first = scored.agg(
        F.count_if(good).alias("good"),
        F.count_if(bad).alias("bad"),
        *[F.max(F.when(good, s)).alias(f"highest_{i}") for i, s in enumerate(score)],
    ).first()
    if not first["good"] or not first["bad"]:
        return None
    lost = min(first["good"] - 1, int(loss * first["good"]))
    ranked = [
        scored.filter(good).select(F.lit(i).alias("i"), s.alias("s")).orderBy(F.desc("s")).offset(lost).limit(1)
        for i, s in enumerate(score)
    ]
    allowed = dict(tuple(r) for r in functools.reduce(DataFrame.unionByName, ranked).collect())
    measures = []
    for i, s in enumerate(score):
        measures.append(F.count_if(bad & (s > allowed[i])).alias(f"above_{i}"))
        measures.append(F.min(F.when(bad & (s > allowed[i]), s)).alias(f"least_{i}"))
        measures.append(F.min(F.when(bad & (s > first[f"highest_{i}"]), s)).alias(f"beyond_{i}"))
    found = scored.agg(*measures).first()
    return [
        Above(allowed[i], first[f"highest_{i}"], first["bad"], found[f"above_{i}"], found[f"least_{i}"], found[f"beyond_{i}"])
        for i in range(groups)
    ]


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, loss: float = CLEAN_LOSS, seed: int = 7
) -> Judge:
    """Forests over labelled rows, and thresholds calibrated on all rows labelled good and bad.

    The forests are grown on at most ``rows`` labelled documents, of which each tree draws a
    subsample; the thresholds are exact order statistics of the scores of every labelled document.
    Rows that the base rule rejects take no part. Of rows with one doc_id one is used. Unless rows of
    both labels are left, the base rule alone rejects.
    """
    spark, every = docs.sparkSession, settled(labelled(labels))
    every = F.broadcast(every) if every.count() <= LABELS_BROADCAST else every
    found = map_arrow(texts(docs).join(every, "doc_id"), _features, "doc_id long, label int, row array<double>")
    found = settled(found.groupBy("doc_id", "label").agg(F.min("row").alias("row")))
    failed = (F.col("row")[0] < MIN_WORDS) | (100 * F.col("row")[4] > 50 * F.col("row")[0])
    passing = found.filter(~failed)
    chosen = passing.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    if not chosen:
        return Judge([])
    points = np.array([r["row"][len(STATISTICS) :] for r in sorted(chosen, key=lambda r: r["doc_id"])])
    groups = [[FEATURES.index(name) for name in group] for group in GROUPS]
    forests = [(columns, IsolationForest.fit(points[:, columns], seed=seed)) for columns in groups]
    shared = spark.sparkContext.broadcast(forests)  # trees and subsample bound its size
    scored = map_arrow(passing.select("label", "row"), functools.partial(_anomalies, shared), "label int, scores array<double>")
    above = _above(settled(scored), len(groups), loss)
    if above is None:
        return Judge([])
    return Judge([(columns, forest, one.threshold(loss)) for (columns, forest), one in zip(forests, above)])


def _judged(judge: Judge, values: list[str | None]) -> list[tuple]:
    """(statistics..., base_failed, anomaly, kept) for each text."""
    found = [statistics(v or "") for v in values]
    scores, rejected = judge.verdicts(np.array([f for _, f in found]).reshape(-1, len(FEATURES)))
    rows = []
    for (counts, _), score, out in zip(found, scores, rejected):
        failed = base_failed(counts[0], counts[4])
        rows.append((*counts, failed, float(score), not failed and not out))
    return rows


_JUDGED = pa.schema(
    [("doc_id", pa.int64()), *[(n, pa.int64()) for n in STATISTICS]]
    + [("base_failed", pa.bool_()), ("anomaly", pa.float64()), ("kept", pa.bool_())]
)


def _judge(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _judged(shared.value, batch["text"].to_pylist())
        columns = list(zip(*rows)) if rows else [[]] * (len(_JUDGED) - 1)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_JUDGED)[1:])]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], schema=_JUDGED)


def judged(docs: DataFrame, judge: Judge) -> DataFrame:
    """Statistics and verdict, one row per row of ``docs``.

    NULL and empty texts have no words and fail the base rule; NULL and repeated doc_ids and equal
    rows stay as they are; an empty table gives no row; other columns are left out. The statistics
    of a text of any length are exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(judge)  # trees and subsample bound its size
    counts = ", ".join(f"{n} long" for n in STATISTICS)
    return map_arrow(
        texts(docs), functools.partial(_judge, shared), f"doc_id long, {counts}, base_failed boolean, anomaly double, kept boolean"
    )


def _kept(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _judged(shared.value, batch["text"].to_pylist())
        yield batch.filter(pa.array([r[-1] for r in rows], pa.bool_()))


def keep_good(docs: DataFrame, judge: Judge) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(judge)
    return map_arrow(docs, functools.partial(_kept, shared), docs.schema)
