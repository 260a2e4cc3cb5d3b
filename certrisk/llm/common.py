"""Helpers of the text operators: Arrow batches as flat byte arrays, hashes, and words.

A batch of texts is one array of UTF-8 bytes with the places where its rows start, so
that numpy works on all rows at once. Null texts are empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Text bytes worked on at a time. A single longer text makes a slice of its own.
SLICE_BYTES = 1 << 18
#: Limits of an Arrow batch: two tasks' batches and their copies must fit beside the JVM.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2_000
#: An odd multiplier of polynomial hashes and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Longer spans are hashed by xxh3: from about a thousand bytes on, sums of powers modulo 2**64 collide by construction.
LONG_SPAN = 256
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches of texts hold a few MB instead of the usual 64, in this session from now on."""
    for key, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        key = f"spark.sql.execution.arrow.{key}"
        if int(spark.conf.get(key).rstrip("bB")) > most:
            spark.conf.set(key, str(most))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each write go when it ends, and not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unused(df: DataFrame, name: str = "own") -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory to the system: idle Python workers share an executor with busy ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and the start of each row with the end of the last."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    starts = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[starts[0]:starts[-1]], starts - starts[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` text bytes, one row at least."""
    if not batch.num_rows:
        return
    _, starts = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end
    give_back()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and INVERSE to the powers 0 to n, kept for the next call if not very long."""
    known = _powers.get(0)
    if known is None or len(known[0]) <= n:
        size = max(n + 1, SLICE_BYTES * 2)
        known = []
        for base in (BASE, INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            known.append(np.multiply.accumulate(p))
        known = tuple(known)
        if size <= SLICE_BYTES * 4:
            _powers[0] = known
    return known


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Entry i hashes the first i bytes, so that two entries give the hash of what lies between."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Scrambled hashes of the bytes from ``start`` to ``end``; equal bytes have equal hashes."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
    return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``, also of long ones."""
    out = span_hashes(prefix_hashes(data), start, end)
    for k in np.flatnonzero(end - start > LONG_SPAN):
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:end[k]].tobytes())
    return out


def same_bytes(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans of ``sizes`` bytes at both places are equal."""
    ends = np.cumsum(sizes)
    inside = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    differ = a[np.repeat(a_start, sizes) + inside] != b[np.repeat(b_start, sizes) + inside]
    out = np.ones(len(sizes), bool)
    out[np.searchsorted(ends, np.flatnonzero(differ), "right")] = False
    return out


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all rows: start, end, row. No word crosses rows."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = (data != 32) & ((data < 9) | (data > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = inside[inner]
    ends[inner - 1] = inside[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(starts, first, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
