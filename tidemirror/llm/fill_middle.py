"""Fill-in-middle: whole texts cut at ranks of their units, which a skip list turns into code points.

A unit is a run of ASCII letters or any other single character. The units of a batch of texts
form an indexable skip list: on every lane each link tells how many units and how many code
points it leaps, and every ``FAN``-th node of a lane also stands on the lane above. A rank is
reached by following a lane as long as its links do not leap too far, then going down one; the
widths gathered on the way are the place of the cut. No unit is ever made a string.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.shared import free_name
from tidemirror.llm.texts import counts_by_text, flat, slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = ["n", "form", "prefix_chars", "middle_chars", "output"]


@dataclass(frozen=True)
class Settings:
    """Of 100 texts so many are cut, and of 100 cut ones so many begin with their suffix."""

    cut: int = 90
    suffix_first: int = 20
    salt: str = "1:"


class SkipList:
    """Units in order; ``lanes`` holds units and code points leapt by each link, the slowest lane first."""

    def __init__(self, widths: np.ndarray):
        self.lanes = [(np.ones(len(widths), np.int64), widths.astype(np.int64))]
        while len(self.lanes[-1][0]) > FAN:
            nodes = np.arange(0, len(self.lanes[-1][0]), FAN)
            self.lanes.append(tuple(np.add.reduceat(leap, nodes) for leap in self.lanes[-1]))

    def seek(self, ranks: np.ndarray) -> np.ndarray:
        """Code points before the unit of each rank; the number of units is a rank too."""
        node, chars, left = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64), ranks.astype(np.int64)
        for units, widths in reversed(self.lanes):
            node *= FAN
            moving = np.flatnonzero(node < len(units))
            while len(moving):
                moving = moving[units[node[moving]] <= left[moving]]
                at = node[moving]
                left[moving] -= units[at]
                chars[moving] += widths[at]
                node[moving] += 1
                moving = moving[node[moving] < len(units)]
        return chars


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of every unit of all texts, and the bounds of each text's units."""
    data, offsets = flat(column)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    code_point = (data & 0xC0) != 0x80
    letter = ((data | np.uint8(32)) - np.uint8(97)) < 26
    joined = np.zeros(len(data), bool)
    joined[1:] = letter[1:] & letter[:-1]
    # A letter that opens a text opens a unit.
    opens = offsets[:-1][offsets[:-1] < len(data)]
    joined[opens] = False
    starts = np.flatnonzero(code_point & ~joined)
    return np.add.reduceat(code_point.astype(np.int64), starts), counts_by_text(starts, offsets)


def cuts(column: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and code points of its prefix and middle; the cuts are the two numbers modulo units + 1."""
    widths, bounds = units(column)
    n = np.diff(bounds)
    a, b = first % (n + 1), second % (n + 1)
    if not len(widths):
        return n, np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    places = SkipList(widths).seek(np.concatenate([bounds[:-1], bounds[:-1] + np.minimum(a, b), bounds[:-1] + np.maximum(a, b)]))
    begin, low, high = places.reshape(3, -1)
    return n, low - begin, high - low


def numbers(doc_id: Column, salt: str) -> list[Column]:
    """Four 32-bit numbers of a document; a missing id is an empty one."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """All columns, and ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A null text counts as empty; an empty one stays plain, as does one that holds a marker. The
    lengths of plain texts are null. The form and the cuts follow from the id alone, so rows
    that share it are treated alike, and rows without an id too. Repeated rows stay, an empty
    table gives an empty table, columns named as the added ones are replaced.
    """
    settings = settings or Settings()
    docs = docs.drop(*ADDED)
    first, second = free_name(docs, "first_cut"), free_name(docs, "second_cut")
    h1, h2, h3, h4 = numbers(F.col(doc_id), settings.salt)
    schema = with_fields(docs.schema, n="bigint", prefix_chars="bigint", middle_chars="bigint")

    def run(batches):
        for batch in slices(batches, text):
            ranks = [batch.column(c).to_numpy() for c in (first, second)]
            found = cuts(batch.column(text), *ranks)
            own = [c for c in batch.schema.names if c not in (first, second)]
            added = [pa.array(x.astype(np.int64)) for x in found]
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), *added], [*own, "n", "prefix_chars", "middle_chars"])

    cut = docs.withColumns({first: h1, second: h2}).mapInArrow(run, schema)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    plain = (whole == "") | marked | (h3 % 100 >= settings.cut)
    cut = cut.withColumn("form", F.when(plain, PLAIN).when(h4 % 100 < settings.suffix_first, SPM).otherwise(PSM))
    a, b = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring(whole, F.lit(1), a), F.substring(whole, a + 1, b)
    suffix = F.substring(whole, a + b + 1, F.length(whole))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = F.when(F.col("form") == PLAIN, whole).when(F.col("form") == PSM, F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    lengths = {c: F.when(F.col("form") != PLAIN, F.col(c)) for c in ("prefix_chars", "middle_chars")}
    return cut.withColumn("output", output).withColumns(lengths).select(*docs.columns, *ADDED)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of, from the output and its form alone.

    No part holds a marker, so the three markers of a cut output are the only ones.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == PSM, F.concat(part(1), part(3), part(2))).when(form == SPM, F.concat(part(2), part(3), part(1))).otherwise(output)
