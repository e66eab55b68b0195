"""What the operators' tasks share: code shipping, Arrow text access, word bounds, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from reviewmart import scratch
from reviewmart.shipping import ship_package

# Work arrays are some tens of bytes for each byte of text.
CHUNK_BYTES = 1 << 20
# Rows in one Arrow batch; texts of a batch are in memory together.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write the rows once and read them; then give back the disk their making took.

    Shuffle files go when the driver's garbage collector finds that nothing refers to
    them any more.  On its own it may not run for a long time, as the driver makes little
    garbage, while the executors' disks fill.
    """
    table = scratch.stage(df, label, folder)
    df.sparkSession.sparkContext._jvm.System.gc()
    return table


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for other tasks, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings, and where each begins and ends; null is empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: int = 1) -> Iterator[tuple]:
    """Pieces of a batch with about CHUNK_BYTES of text: rows, bytes, offsets.

    A longer text is a piece of its own; no text is cut.
    """
    data, offsets = utf8(batch.column(text))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        begin, end = offsets[low], offsets[high]
        yield batch.slice(low, high - low), data[begin:end], offsets[low : high + 1] - begin
        low = high


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """Start and end of every word, and the number of words before each document."""
    word = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    ends = word
    ends = ends.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(32)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> SHIFT)) * MIX
    h = (h ^ (h >> SHIFT)) * MIX2
    return h ^ (h >> SHIFT)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    h = size.astype(np.uint64) * MIX2
    left = np.arange(len(starts))
    at = 0
    while len(left):
        n = np.minimum(size[left] - at, 8).astype(np.uint64)
        part = eight[starts[left] + at] & (~np.uint64(0) >> ((np.uint64(8) - n) << np.uint64(3)))
        h[left] = mixed(h[left] ^ part)
        at += 8
        left = left[size[left] > at]
    return h


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive items of ``h``, by doubling."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    out, have = None, 0
    power, size, factor = h, 1, np.array([MIX])
    while True:
        if width & size:
            if out is None:
                out, have = power, size
            else:
                n = len(h) - have - size + 1
                out = out[:n] * factor + power[have : have + n]
                have += size
        size *= 2
        if size > width:
            return mixed(out[: len(h) - width + 1])
        n = len(h) - size + 1
        power = power[:n] * factor + power[size // 2 : size // 2 + n]
        factor = factor * factor


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive items, by doubling."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: each item's group and its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - before[group]
