"""Secret scans: fixed patterns, and windows of high Shannon entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A maximal run of the class that is long enough: the same matches as the run
# without a length whose short ones are dropped.
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("passw", "secret", "token", "api")
MIN_VALUE, MIN_ACCESS = 8, 16
BASE_KINDS = ("assign", "access", "hex")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
IS_HEX = re.compile(r"[0-9a-fA-F]+\Z")
# Strings that look random but are no secrets.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[0-9]+",
    r"[A-Z]?[a-z]+([-_/][A-Z]?[a-z]+)*",
    r"(?i:.*(example|placeholder|xxxx|abcdefgh|01234567).*)",
)


@dataclass(frozen=True)
class EntropyClass:
    """Strings of one character class are judged in windows of ``window`` characters, from ``bits`` on."""

    name: str
    window: int
    bits: float


HEX_CLASS = EntropyClass("entropy_hex", 20, 3.0)
ALPHA_CLASS = EntropyClass("entropy_alpha", 20, 3.9)
MIXED_CLASS = EntropyClass("entropy_mixed", 20, 3.7)
ENTROPY_KINDS = tuple(c.name for c in (HEX_CLASS, ALPHA_CLASS, MIXED_CLASS))
KINDS = BASE_KINDS + ENTROPY_KINDS


def class_of(text: str) -> EntropyClass:
    if IS_HEX.match(text):
        return HEX_CLASS
    return ALPHA_CLASS if text.isalpha() else MIXED_CLASS


def high_entropy(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Maximal stretches covered by windows whose Shannon entropy is at least ``bits``.

    The counts of a window follow from those of the one before: one character
    leaves, one enters, and the sum of c * log2(c) changes by these two alone.
    """
    if len(text) < window:
        return []
    part = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for i, new in enumerate(text):
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += part[c - 1] - part[c]
            counts[old] = c - 1
        c = counts.get(new, 0)
        total += part[c + 1] - part[c]
        counts[new] = c + 1
        start = i - window + 1
        if start >= 0 and math.log2(window) - total / window >= bits - 1e-9:
            if found and found[-1][1] >= start:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def scan(text: str, allow: re.Pattern) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text, by start and then by kind as listed."""
    spans: list[tuple[str, int, int]] = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = sorted((s, e) for _, s, e in spans)
    for m in CANDIDATE.finditer(text):
        string = m[0]
        if allow.fullmatch(string):
            continue
        kind = class_of(string)
        for start, end in high_entropy(string, kind.window, kind.bits):
            start, end = start + m.start(), end + m.start()
            if not any(s <= start and end <= e for s, e in base):
                spans.append((kind.name, start, end))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(
    docs: DataFrame, allow: tuple[str, ...] = ALLOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, spans) for each row of ``docs``; a span is (kind, start, end) in code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are fixed patterns and always stay. An
    ``entropy_*`` span is a stretch of a long string whose sliding windows reach
    the bits of the string's character class; strings matching ``allow`` as a
    whole, and stretches inside a span of a fixed pattern, are left out.
    A missing or empty text has no span; a row without an id is scanned like any
    other; repeated rows come out as often as they go in; other columns are not
    read. No row moves between machines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)")
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in scan(t, allowed)] if t else []
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPANS)], names=["id", "spans"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    scanned = texts.mapInArrow(run, "id bigint, spans array<struct<kind string, start bigint, end bigint>>")
    return scanned.select(F.col("id").alias(id_col), "spans")
