"""Secret scans: known forms, and strings whose characters are too evenly spread to be words.

Candidate strings are runs of token characters. A window slides over each; the counts of
its characters, and with them its Shannon entropy, change by one character in and one
out. Each character class has its own window and limit. An allow-list removes strings
that look random but are known to be harmless.
"""

from __future__ import annotations

import math
import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.texts import flat, lower_ascii, runs, slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ["assign", "access", "hex", "entropy"]
BASE = 3

# The known forms.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ASSIGN_WORDS = [b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"]
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32


@dataclass(frozen=True)
class EntropyClass:
    """Strings of these characters are random where a window holds at least ``bits`` per character."""

    name: str
    characters: re.Pattern
    window: int
    bits: float


CLASSES = [
    EntropyClass("hex", re.compile(rb"[0-9a-fA-F]+"), 20, 2.9),
    EntropyClass("alphanumeric", re.compile(rb"[A-Za-z0-9]+"), 20, 3.6),
    EntropyClass("base64", re.compile(rb"[A-Za-z0-9+/_=-]+"), 20, 3.8),
]
CANDIDATE_LEAST = 20

# Harmless strings: numbers and dates, identifiers in the 8-4-4-4-12 form, path-like and
# hyphenated words, runs of the alphabet, and keys that documentation gives as examples.
ALLOW = [
    re.compile(rb"[0-9_/+=.-]*"),
    re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(rb"([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))+[-_/=+]*"),
    re.compile(rb"(?i).*(example|abcdefghij|0123456789).*"),
]


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(characters, np.uint8)] = True
    return out


_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
IS_HEX = _table(_DIGITS + b"abcdef")
IS_ACCESS = _table(_DIGITS + _UPPER)
IS_TOKEN = _table(_DIGITS + _UPPER + _UPPER.lower() + b"+/_=-")
IS_DIGIT = _table(_DIGITS)


def random_part(piece: bytes, window: int, bits: float) -> tuple[int, int] | None:
    """Bounds of all windows with at least ``bits`` of entropy per character, or None."""
    if len(piece) < window:
        return None
    counts = [0] * 256
    # Entropy is log2(window) - total / window, where total sums c * log2(c) over the counts.
    terms = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    most = (math.log2(window) - bits) * window + 1e-9
    total, first, last = 0.0, -1, -1
    for i, c in enumerate(piece):
        if i >= window:
            gone = piece[i - window]
            total += terms[counts[gone] - 1] - terms[counts[gone]]
            counts[gone] -= 1
        total += terms[counts[c] + 1] - terms[counts[c]]
        counts[c] += 1
        if i >= window - 1 and total <= most:
            first = i - window + 1 if first < 0 else first
            last = i + 1
    return None if first < 0 else (first, last)


def entropy_span(piece: bytes, classes=CLASSES, allow=ALLOW) -> tuple[int, int] | None:
    """The random part of a candidate, by the narrowest class that holds it, unless it is allowed."""
    if not re.search(rb"[0-9]", piece) or not re.search(rb"[A-Za-z]", piece) or any(a.fullmatch(piece) for a in allow):
        return None
    for one in classes:
        if one.characters.fullmatch(piece):
            return random_part(piece, one.window, one.bits)
    return None


def _scan(column: pa.Array, classes, allow) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) in code points, by start and kind, for every text."""
    data, offsets = flat(column)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]

    def add(kind: int, start: int, end: int) -> None:
        spans[int(np.searchsorted(offsets, start, "right")) - 1].append((kind, int(start), int(end)))

    def long_runs(table: np.ndarray, least: int):
        starts, ends = runs(table[data], offsets)
        kept = ends - starts >= least
        return starts[kept], ends[kept]

    raw, low = data.tobytes(), lower_ascii(data).tobytes()
    named = set()
    for word in ASSIGN_WORDS:
        at = low.find(word)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            named.add(text)
            at = low.find(word, int(offsets[text + 1]))
    for text in named:
        begin = int(offsets[text])
        for m in ASSIGN.finditer(raw[begin : offsets[text + 1]]):
            if len(m[2]) >= ASSIGN_LEAST:
                spans[text].append((0, begin + m.start(), begin + m.end()))
    for start, end in zip(*long_runs(IS_ACCESS, ACCESS_LEAST)):
        at = raw.find(b"AKIA", start, end)
        if at >= 0 and end - at >= ACCESS_LEAST:
            add(1, at, end)
    for start, end in zip(*long_runs(IS_HEX, HEX_LEAST)):
        add(2, start, end)
    starts, ends = long_runs(IS_TOKEN, CANDIDATE_LEAST)
    digits = np.concatenate([[0], np.cumsum(IS_DIGIT[data], dtype=np.int64)])
    mixed = (digits[ends] > digits[starts]) & (digits[ends] - digits[starts] < ends - starts)
    for start, end in zip(starts[mixed].tolist(), ends[mixed].tolist()):
        found = entropy_span(raw[start:end], classes, allow)
        if found:
            text = int(np.searchsorted(offsets, start, "right")) - 1
            own = (start + found[0], start + found[1])
            if not any(s < own[1] and own[0] < e for _, s, e in spans[text]):
                spans[text].append((BASE, *own))
    points = None
    for text, own in enumerate(spans):
        if own:
            if points is None:
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
            zero = points[offsets[text]]
            spans[text] = sorted(
                ((k, int(points[s] - zero), int(points[e] - zero)) for k, s, e in own), key=lambda x: (x[1], x[0])
            )
    return spans


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", classes=CLASSES, allow=ALLOW) -> DataFrame:
    """``doc_id`` and ``spans``: kind (index in ``KINDS``), start and end in code points, end exclusive.

    Spans of the known forms are all reported; a random string is added where no span
    touches it. A null or empty text has no spans. Null ids and repeated rows are passed on,
    an empty table gives an empty result, other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = with_fields(docs.drop("text").schema, spans="array<struct<kind:int,start:bigint,end:bigint>>")

    def run(batches):
        for batch in slices(batches, "text"):
            found = _scan(batch.column("text"), classes, allow)
            rows = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in own] for own in found], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "spans"])

    return docs.mapInArrow(run, schema)


def count_kind(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def base_spans(spans: str = "spans") -> Column:
    return F.filter(spans, lambda s: s["kind"] < BASE)


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans count as one."""
    ends = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda done, s: F.when(s["end"] <= done["at"], done).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] < done["at"], done["out"])
                .otherwise(F.concat(done["out"], text.substr((done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")), F.lit(mark)))
                .alias("out"),
            )
        ),
    )
    return F.concat(ends["out"], text.substr((ends["at"] + 1).cast("int"), F.length(text)))
