"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score (operator 3)."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.frames import map_arrow, texts

#: Kinds in the order in which spans are listed; the first four are reported whatever their score.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
THRESHOLD = 0.6
CONTEXT_CHARS = 48
PATTERN_SCORE, CHECKSUM_SCORE, CONTEXT_SCORE = 0.4, 0.4, 0.3

# Words that make a kind likelier when they stand near a span.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "mastercard", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security"),
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits implies one at the start of the run, so starts inside are skipped.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[a-z-]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of an account number: country and check digits moved behind, letters as 10 to 35."""
    plain = account.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What stands before an @ cannot hold another one, so each @ has one possible start."""
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            behind = domain.end()
            yield start, behind
        at = text.find("@", max(at + 1, behind))


def _ip_valid(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _card_valid(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_valid(found: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", found)) <= 15


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, confirmed by a checksum) of spans whose form and checks hold."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end, False
    for match in _IP.finditer(text):
        if _ip_valid(match.group()):
            yield "ip", *match.span(), False
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13 and _card_valid(match.group()):
            yield "card", *match.span(), True
    if "+" in text:
        for match in _PHONE.finditer(text):
            if _phone_valid(match.group()):
                yield "phone", *match.span(), False
    for match in _IBAN.finditer(text):
        if mod97(match.group()):
            yield "iban", *match.span(), True
    for match in _SSN.finditer(text):
        yield "ssn", *match.span(), False


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    hinted = not set(CONTEXT[kind]).isdisjoint(_WORD.findall(near.lower()))
    return round(PATTERN_SCORE + CHECKSUM_SCORE * confirmed + CONTEXT_SCORE * hinted, 2)


def find_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start; code points, end exclusive."""
    spans = []
    for kind, start, end, confirmed in proposals(text):
        points = min(1.0, score(text, kind, start, end, confirmed))
        if kind in BASE_KINDS or points >= threshold:
            spans.append((kind, start, end, points))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def spans_column(find, values: list[str | None]) -> pa.Array:
    names = [f.name for f in SPAN]
    return pa.array([[dict(zip(names, s)) for s in find(v or "")] for v in values], pa.list_(SPAN))


def _scan(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = spans_column(functools.partial(find_spans, threshold=threshold), batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], found], names=["doc_id", "spans"])


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, score), one row per row of ``docs``.

    E-mail addresses, IP addresses, card numbers (Luhn) and phone numbers are reported wherever their
    form and checks hold; account numbers (mod 97) and social security numbers only from a score of
    ``threshold``. NULL and empty texts have no spans; NULL and repeated doc_ids and equal rows stay
    as they are; an empty table gives no row; other columns are left out. Texts of any length are
    searched whole, in time proportional to their length.
    """
    return map_arrow(
        texts(docs),
        functools.partial(_scan, threshold),
        "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>",
    )


def listed(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined; of some kinds or all."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else F.col(spans)
    return F.array_join(
        F.transform(
            some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
