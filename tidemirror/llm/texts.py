"""Texts in Arrow batches as flat byte arrays: word bounds and hashes without Python strings.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. All arrays are about one slice of a batch, whose bytes are bounded by
``SLICE_BYTES`` unless a single text is longer.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

# Worker functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2 << 20
_PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Every batch cut into parts of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offset of each text with the total at the end; null is empty."""
    values = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    if not len(values) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data | (((data - np.uint8(65)) < 26).astype(np.uint8) << np.uint8(5))


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data - np.uint8(9)) < 5)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends with its text."""
    size = len(mask)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.zeros(size + 1, bool)
    cuts[offsets] = True
    opens = mask.copy()
    opens[1:] &= ~mask[:-1] | cuts[1:size]
    closes = mask.copy()
    closes[:-1] &= ~mask[1:] | cuts[1:size]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def counts_by_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds in ``starts`` of each text's runs: those of text i are ``[out[i], out[i + 1])``."""
    return np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3, on unsigned numbers."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run, taken piece by piece to bound memory."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
        first, own = starts[at], starts[at:to] - starts[at]
        lengths = ends[at:to] - starts[at:to]
        powers = np.cumprod(np.full(int(lengths.max()), _BASE))
        where = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        values = data[np.repeat(own, lengths) + where + first].astype(np.uint64) + np.uint64(1)
        sums = np.add.reduceat(values * powers[where], np.cumsum(lengths) - lengths)
        out[at:to] = mix(sums ^ (lengths.astype(np.uint64) << np.uint64(32)))
        at = to
    return out


def hash_windows(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes, in order, over the whole array."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - size + 1, salt, np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for k in range(size):
        total = total * factor + words[k : len(words) - size + 1 + k]
    return mix(total)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def with_fields(schema: StructType, **types: str) -> StructType:
    """A schema with more fields at its end, their types written as in DDL."""
    more = [StructField(name, _parse_datatype_string(kind)) for name, kind in types.items()]
    return StructType([*schema.fields, *more])
