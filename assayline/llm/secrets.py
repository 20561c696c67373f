"""Secrets: patterns propose candidates, their inner structure confirms them (operator 5)."""

from __future__ import annotations

import base64
import binascii
import functools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from assayline.llm.frames import map_arrow, texts
from assayline.llm.pii import spans_column

#: Kinds in the order in which spans of one start are listed; the first three need no confirmation.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("private_key", "signed_token", "key_encoding")
KINDS = BASE_KINDS + ADDED_KINDS
MASK = "[SECRET]"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}+")  # leftmost, so it starts where its run starts
_PEM = re.compile(
    r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----((?:\s*[A-Za-z][A-Za-z-]*:[^\n]*\n)*+)([A-Za-z0-9+/=\s]*)-----END \1-----"
)
_CIPHER = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,([0-9A-Fa-f]{16,})")
_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: Headers with white space behind the brace.
_SPACED_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?:eyA|ewo|ew0|ewk)[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_.-])M[A-Za-z0-9+/]{39,}+={0,2}")
#: The first line of a longer encoding and the lines behind it; how many belong to it, its length says.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_.-])M[A-Za-z0-9+/]{39,}+(?:\r?\n[\x20\t]*[A-Za-z0-9+/]++={0,2}+)++")
_HEX_DER = re.compile(r"(?<![0-9A-Za-z])30[0-9A-Fa-f]{62,}+(?![0-9A-Za-z])")
_SEQUENCE, _INTEGER, _OBJECT, _OCTETS = 0x30, 0x02, 0x06, 0x04


def _decoded(value: str) -> bytes | None:
    plain = "".join(value.split()).translate({ord("-"): "+", ord("_"): "/"}).rstrip("=")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


def element(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the element at ``at``, if its length stays inside."""
    if at + 2 > len(data):
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or start + count > len(data):
            return None
        size = int.from_bytes(data[start : start + count])
        start += count
    return (tag, start, start + size) if start + size <= len(data) else None


def is_key_encoding(data: bytes | None) -> bool:
    """One sequence that fills the data, whose elements fill it and begin with a small version."""
    outer = element(data, 0) if data else None
    if not outer or outer[0] != _SEQUENCE or outer[2] != len(data):
        return False
    at, tags, version = outer[1], [], None
    while at < outer[2]:
        inner = element(data, at)
        if not inner or inner[2] > outer[2]:
            return False
        if not tags and inner[0] == _INTEGER and inner[2] - inner[1] == 1:
            version = data[inner[1]]
        tags.append(inner[0])
        at = inner[2]
    return version in (0, 1, 2) and len(tags) >= 3


def is_encrypted_key(data: bytes | None) -> bool:
    """One sequence that fills the data and holds an algorithm, which begins with its identifier, and octets."""
    outer = element(data, 0) if data else None
    if not outer or outer[0] != _SEQUENCE or outer[2] != len(data):
        return False
    algorithm = element(data, outer[1])
    octets = element(data, algorithm[2]) if algorithm else None
    if not octets or algorithm[0] != _SEQUENCE or octets[0] != _OCTETS or octets[2] != len(data):
        return False
    name = element(data, algorithm[1])
    return bool(name and name[0] == _OBJECT and name[2] <= algorithm[2] and octets[2] > octets[1])


def _is_key(data: bytes | None) -> bool:
    return is_key_encoding(data) or is_encrypted_key(data)


def wrapped_key_end(text: str, start: int, end: int) -> int | None:
    """Where the key encoding ends that begins at ``start`` and is wrapped over lines, if it is one.

    Its first bytes state its length, which says how many of the characters belong to it.
    """
    head = _decoded(text[start : start + 8])
    if not head or len(head) < 6 or head[0] != _SEQUENCE:
        return None
    size, begins = head[1], 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4:
            return None
        size, begins = int.from_bytes(head[2 : 2 + count]), 2 + count
    wanted = -(-4 * (begins + size) // 3)  # characters without padding
    place = start
    while wanted and place < end:
        wanted -= not text[place].isspace() and text[place] != "="
        place += 1
    padded = place
    while padded < end and text[padded] == "=" and padded < place + 2:
        padded += 1
    goes_on = padded < len(text) and (text[padded].isalnum() or text[padded] in "+/=")
    return padded if not wanted and not goes_on and _is_key(_decoded(text[start:place])) else None


def is_token_header(value: str) -> bool:
    """The first part of a signed token: a JSON object that names an algorithm."""
    data = _decoded(value)
    try:
        header = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed; code points, end exclusive.

    The score is 1 where the structure of the span was decoded and confirmed, else 0.5.
    """
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        for match in _ASSIGN.finditer(text):
            if len(match.group(2)) >= 8:
                sure = _is_key(_decoded(match.group(2))) or is_token_header(match.group(2).partition(".")[0])
                spans.append(("assign", *match.span(), 1.0 if sure else 0.5))
    if "AKIA" in text:
        spans.extend(("access", *m.span(), 0.5) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16)
    spans.extend(("hex", *m.span(), 0.5) for m in _HEX.finditer(text))
    if "PRIVATE KEY-----" in text:
        for match in _PEM.finditer(text):
            headers, data = match.group(2), _decoded(match.group(3))
            opened = data is not None and data.startswith(b"openssh-key-v1\0")
            sealed = bool(data) and len(data) % 8 == 0 and "ENCRYPTED" in headers and _CIPHER.search(headers)
            if opened or sealed or _is_key(data):
                spans.append(("private_key", *match.span(), 1.0))
    if "eyJ" in text:
        for match in _TOKEN.finditer(text):
            if is_token_header(match.group().partition(".")[0]):
                spans.append(("signed_token", *match.span(), 1.0))
    if any(brace in text for brace in ("eyA", "ewo", "ew0", "ewk")):
        for match in _SPACED_TOKEN.finditer(text):
            if is_token_header(match.group().partition(".")[0]):
                spans.append(("signed_token", *match.span(), 1.0))
    for match in _BASE64.finditer(text):
        if _is_key(_decoded(match.group())):
            spans.append(("key_encoding", *match.span(), 1.0))
    for match in _WRAPPED.finditer(text):
        end = wrapped_key_end(text, *match.span())
        if end is not None and "\n" in text[match.start() : end]:
            spans.append(("key_encoding", match.start(), end, 1.0))
    for match in _HEX_DER.finditer(text):
        if len(match.group()) % 2 == 0 and is_key_encoding(bytes.fromhex(match.group())):
            spans.append(("key_encoding", *match.span(), 1.0))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = spans_column(find_spans, batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], found], names=["doc_id", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, score), one row per row of ``docs``.

    Assignments, access keys and long hexadecimal runs are reported by form. Private keys, signed
    tokens and bare key encodings are reported only if they decode: base64 or hexadecimal to one
    sequence with nested lengths that fit, on one line or wrapped over several, encrypted or not, or to
    a header that names an algorithm. NULL and empty
    texts have no spans; NULL and repeated doc_ids and equal rows stay as they are; an empty table
    gives no row; other columns are left out. Texts of any length are searched whole.
    """
    return map_arrow(
        texts(docs), _scan, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"
    )


def masked(text: str) -> str:
    """The text with every span, or run of overlapping spans, replaced by the mask."""
    parts, at = [], 0
    for _, start, end, _ in find_spans(text):
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        values = [None if t is None else masked(t) for t in batch["text"].to_pylist()]
        batch = batch.set_column(names.index("text"), batch.schema.field("text"), pa.array(values, batch.schema.field("text").type))
        if "n_chars" in names:
            field = batch.schema.field("n_chars")
            sizes = [o if v is None else len(v) for o, v in zip(batch["n_chars"].to_pylist(), values)]
            batch = batch.set_column(names.index("n_chars"), field, pa.array(sizes, field.type))
        yield batch


def without_secrets(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its secrets masked, ``n_chars`` adjusted, other columns as they are."""
    return map_arrow(docs, _masked, docs.schema)
