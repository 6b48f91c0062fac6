"""Text columns as byte buffers, for numpy inside tasks.

A task sees Arrow batches. Each is cut into blocks of a few MB, so that arrays
over all bytes of a block stay small; one text longer than a block is a block.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 * 1024 * 1024
SMALL_BLOCK = BLOCK_BYTES // 4  # where a task holds 40 bytes and more for each byte of a block

# A null id stands before all others.
NULL_ID = -(2**63)

# White space of the word pattern [^\x20\x09-\x0D]+, as a table over bytes.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)


def shipped(spark: SparkSession, value):
    """A broadcast of ``value`` that also carries its classes; open it with ``opened``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared):
    return pickle.loads(shared.value)


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _id, _h): ``_id`` without nulls, ``_h`` tells apart the rows that share an id."""
    return docs.select("doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_h"),
    )


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets): row i's text is bytes[offsets[i]:offsets[i + 1]]; null is empty."""
    for batch in batches:
        data, offsets = buffer_of(batch.column(column))
        start, n = 0, batch.num_rows
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), n)
            first, last = offsets[start], offsets[stop]
            yield (
                batch.slice(start, stop - start),
                data[first:last],
                (offsets[start : stop + 1] - first).astype(np.int64),
            )
            start = stop


def give_back() -> None:
    """Return free memory to the system, at the end of a task: its worker lives on and serves others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def gives_back(run: Callable) -> Callable:
    """A task's function that returns free memory once it has read and written all."""

    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return to_the_end


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string or binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    kind = np.int64 if "large" in str(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words_of(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words as maximal runs of bytes that are not blank.

    Words of row i are those from first[i] to first[i + 1].
    """
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = ~blank[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside[:-1]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from differences of one running sum over the bytes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(BASE, len(data)), dtype=np.uint64, out=sums[1:])
    back = powers(INVERSE, len(data) + 1)
    value = (sums[ends] - sums[starts]) * back[starts]
    return mixed(value + (ends - starts).astype(np.uint64))

