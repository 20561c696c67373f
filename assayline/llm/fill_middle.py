"""Fill-in-the-middle rewriting of documents (operator 13)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, texts

# The marks of the output format and the shares of its forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
REWRITTEN_PERCENT = 50
SPM_PERCENT = 80
SEED = 42

SPACE, WORD, WORD_END, LAST_SPACE = 0, 1, 2, 3  # classes of code points
CLASS_BITS = 2

SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, suffix_chars long, output string"
)
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
BATCH_CHARS = 4_000_000


class WaveletMatrix:
    """Ranks of small classes over a sequence: one bit plane a level, the highest bit first.

    On each level the elements with a zero bit move in front of those with a one, both in order, so a
    class is one range at the bottom. ``ones`` holds the ones before every position of each level.
    """

    def __init__(self, classes: np.ndarray, bits: int = CLASS_BITS) -> None:
        self.size, self.bits = len(classes), bits
        self.ones: list[np.ndarray] = []
        for shift in range(bits - 1, -1, -1):
            plane = (classes >> shift) & 1
            ones = np.zeros(self.size + 1, dtype=np.int32)
            np.cumsum(plane, out=ones[1:])
            self.ones.append(ones)
            set_bits = plane.astype(bool)
            classes = np.concatenate([classes[~set_bits], classes[set_bits]])

    def rank(self, value: int, end: int) -> int:
        """How many of the first ``end`` elements have the class."""
        start = 0
        for level, ones in enumerate(self.ones):
            if value >> (self.bits - 1 - level) & 1:
                zeros = self.size - int(ones[-1])
                start, end = zeros + int(ones[start]), zeros + int(ones[end])
            else:
                start, end = start - int(ones[start]), end - int(ones[end])
        return end - start


_SPACES = np.zeros(128, dtype=bool)
_SPACES[[*range(9, 14), 32]] = True


def character_classes(text: str) -> np.ndarray:
    """White space, last white space of the text, inside a word, last of a word; one per code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = _SPACES[np.minimum(points, 127)]
    if not len(points):
        return np.zeros(0, dtype=np.uint8)
    before_space = np.append(space[1:], True)
    classes = np.where(space, SPACE, np.where(before_space, WORD_END, WORD)).astype(np.uint8)
    if space[-1]:
        classes[-1] = LAST_SPACE
    return classes


@dataclass
class Units:
    """The units of a text, a word with the white space before it, or white space at the end."""

    text: str

    def __post_init__(self) -> None:
        self.matrix = WaveletMatrix(character_classes(self.text))
        self.count = self.ended_by(self.matrix.size)

    def ended_by(self, position: int) -> int:
        """Units that end within the first ``position`` code points: ranks of both classes that end one."""
        return self.matrix.rank(WORD_END, position) + self.matrix.rank(LAST_SPACE, position)

    def end_of(self, units: int) -> int:
        """The code points that the first ``units`` units cover, by bisection on the ranks."""
        low, high = 0, self.matrix.size
        while low < high:
            middle = (low + high) // 2
            if self.ended_by(middle) < units:
                low = middle + 1
            else:
                high = middle
        return low


@dataclass
class Draws:
    """Four unsigned integers that a document's id gives."""

    first: int
    second: int
    rewrite: int
    order: int


def draws(doc_id: int | None, seed: int = SEED) -> Draws:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return Draws(*[int(digest[8 * i : 8 * i + 8], 16) for i in range(4)])


def rewritten(text: str, drawn: Draws, rewritten_percent: int, spm_percent: int) -> tuple:
    """Number of units, form, code points of the three parts (None if plain), output."""
    units = Units(text)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or drawn.rewrite % 100 >= rewritten_percent:
        return units.count, "plain", None, None, None, text
    cuts = sorted((drawn.first % (units.count + 1), drawn.second % (units.count + 1)))
    start, end = (units.end_of(c) for c in cuts)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if drawn.order % 100 < spm_percent:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return units.count, form, len(prefix), len(middle), len(suffix), output


def transform(
    docs: DataFrame,
    seed: int = SEED,
    rewritten_percent: int = REWRITTEN_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, code points of the three parts and the ``output`` text.

    A row of ``docs`` gives one row; no row meets another. NULL text counts as empty: no unit, plain,
    empty output. A NULL doc_id draws as an id without digits; repeated ids draw alike, equal rows
    give equal rows. A text that holds one of the marks stays plain, so that every output can be
    taken apart again (:func:`restored`). Texts of any length are cut at whole units; one text is
    held at a time beside its batch, at about twelve bytes a code point. Other columns are left out.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows):
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)

        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                rows.append((doc_id, *rewritten(text, draws(doc_id, seed), rewritten_percent, spm_percent)))
                size += len(text)
                if size >= BATCH_CHARS:
                    yield emit(rows)
                    rows, size = [], 0
            if rows:
                yield emit(rows)

    return map_arrow(texts(docs), rows_of, SCHEMA)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, by its form and marks alone."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(F.col(output), len(first) + 1, 2**31 - 1)
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(one) + len(second) + 1, F.lit(2**31 - 1))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.char_length(two) + len(MIDDLE) + 1, F.lit(2**31 - 1))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
