"""Helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches. ``text_blocks`` cuts a batch into blocks
of bounded bytes (a longer text is a block of its own) so that the numpy
arrays built over a block stay small whatever a batch holds.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import work_path

BLOCK_BYTES = 2 << 20
#: For work whose arrays are many times the block and which gains nothing from a larger one.
SMALL_BLOCK_BYTES = 256 << 10

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor,
    once per application. Spark itself distributes the archive."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tessera-code-")), "tessera_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage,
    and a lost executor re-reads files instead of recomputing."""
    path = work_path(df.sparkSession, f"llm_{name}")
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give back what a task leaves in a Python worker that later tasks reuse:
    the tables of powers, Arrow's free buffers and, with glibc, freed heap pages."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with ``release`` at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return task


def lean_group(run: Callable[[tuple, pa.Table, pa.Table], pa.Table]):
    """``run`` for a cogroup's ``applyInArrow``, with ``release`` after each group."""

    def group(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(key, left, right)
        finally:
            release()

    return group


def partitions(spark: SparkSession) -> int:
    """The cluster's shuffle width, which its owner sizes to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix64): every input bit reaches every output bit."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Rows ``first .. first+n`` of a batch: their UTF-8 bytes one after the
    other, with ``n+1`` offsets. ``valid`` is False for null texts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def text_blocks(column: pa.Array | pa.ChunkedArray, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    offsets = np.frombuffer(offset_buffer, kind, n + 1, column.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        end = min(max(end, at + 1), n)
        yield Block(at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], valid[at:end])
        at = end


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64 (kept for the next block if not huge)."""
    out = _POWERS.get(base)
    if out is None or len(out) <= n:
        out = np.full((1 << max(n, SMALL_BLOCK_BYTES).bit_length()) + 1, np.uint64(base), np.uint64)
        out[0] = 1
        out = np.cumprod(out, dtype=np.uint64)
        if n <= 2 * BLOCK_BYTES + (1 << 20):
            _POWERS[base] = out
    return out[:n + 1]


_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``, from one prefix sum: a
    polynomial over random byte values, finalized together with the length."""
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * powers(_INVERSE, n)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(_BASE, n)[starts]
    return mix(value ^ mix((ends - starts).astype(np.uint64)))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes that never cross a text
    border, and ``counts``: the index of each text's first run (n+1 values)."""
    n = len(is_word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    borders = offsets[:-1][offsets[:-1] < n]
    starts[borders] = is_word[borders]
    stops = is_word.copy()
    stops[:-1] &= ~is_word[1:]
    inner = offsets[1:][(offsets[1:] > 0) & (offsets[1:] <= n)] - 1
    stops[inner] = is_word[inner]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(stops) + 1, np.searchsorted(s, offsets)


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


#: Byte tables: A-Z lower-cased, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
