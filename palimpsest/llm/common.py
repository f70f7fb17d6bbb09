"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checkpoints import cut, shared_folder  # noqa: F401  (operators take them from here)

#: Words are maximal runs of anything but space and \t \n \v \f \r, as in every contract here.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: Bytes of text that a task works on at once; longer single texts are still taken whole.
SLICE_BYTES = 2 << 20


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt_anew(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the column ``dealt``, the key wrapped, to join an aggregation by its own key.

    A join straight on the aggregation's key takes over its partitions, and then adaptive execution
    cannot split a hot key of the other side; a join on the wrapped key deals both sides again.
    """
    return rows.withColumn("dealt", F.struct(key))


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow; afterwards what its task freed goes back to the system, as Spark keeps
    the Python process for later stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)

    return tidied


def trimmed_words(text: Column) -> Column:
    """The words of ``text`` joined by one space; null gives the empty string."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")
    return F.btrim(spaced, F.lit(" "))


def word_count(text: Column) -> Column:
    """Number of words, without making an array of them; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of ``column``."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    group = (np.cumsum(lengths) - lengths) // limit
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = pa.compute.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, row) of each word; a row's end always ends a word."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    inside = ~IS_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(raw)]
    first[edges] |= inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    return x


_BASE = 0x5851F42D4C957F2D
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit polynomial hash of values[start:end] for many spans, from one running sum."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    back = powers(pow(base, -1, 1 << 64), n + 1)
    return mix64((total[ends] - total[starts]) * back[starts])


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word."""
    return span_hashes(_TABLE[raw], starts, ends)
