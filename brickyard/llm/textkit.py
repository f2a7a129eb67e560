"""Shared Arrow / numpy helpers of the text operators.

Everything here works on one bounded slice of an Arrow batch at a time, so the
memory of a task depends on ``BLOCK_BYTES`` and on the longest single text,
never on the number of rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes of text that are turned into numpy arrays at once.
BLOCK_BYTES = 2 << 20
#: Words are hashed in segments of at most this many bytes (a longer word is a segment of its own).
SEGMENT = 1 << 18

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INV = _U(pow(int(_P), -1, 1 << 64))
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: ASCII white space, the separators of the shingle operators.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def prepare(spark: SparkSession) -> None:
    """Arrow batches that stay small for long texts too, and workers that find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    paths = spark.sparkContext.environment
    # freed arrays go back to the system at once: workers stay for all stages of a job and would keep them
    for name, value in (("MALLOC_MMAP_THRESHOLD_", str(1 << 20)), ("MALLOC_TRIM_THRESHOLD_", str(1 << 20)), ("MALLOC_ARENA_MAX", "1"), ("ARROW_DEFAULT_MEMORY_POOL", "system")):
        paths.setdefault(name, value)
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, paths.get("PYTHONPATH")) if x)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` holds about ``limit`` bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    row, done = 0, 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(row, stop - row)
        row, done = stop, int(ends[stop - 1])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column one after another, and the row offsets into them (nulls are empty)."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective), so that equal-looking sums spread over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = SEGMENT
    while size < n:
        size *= 2
    if size not in _powers:
        up, down = np.full(size, _P), np.full(size, _P_INV)
        up[0] = down[0] = 1
        tables = np.cumprod(up), np.cumprod(down)
        if size > SEGMENT:  # a single huge word: not worth keeping
            return tables
        _powers[size] = tables
    return _powers[size]


def byte_codes(lower: bool) -> np.ndarray:
    codes = _BYTE_CODES.copy()
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of non-separator bytes inside a row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~separators[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = word[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend and don't overlap.

    A polynomial over the byte codes, taken from running sums that start anew
    in each segment and shifted back by the inverse power of the span's start.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        size = int(ends[j - 1] - base)
        up, down = _power_tables(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(codes[data[base:base + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, .. of every (start, length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
    return out


def binaries(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column whose row i holds ``values[bounds[i]:bounds[i+1]]``, without a copy per row."""
    step = values.dtype.itemsize
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * step).astype(np.int32)), pa.py_buffer(raw)])
