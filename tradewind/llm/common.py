"""Helpers shared by the operators: stored intermediates, packed text, bytes to words, bounded samples."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import scratch_path

#: Word separators as bytes: space and the controls 9 to 13. UTF-8 never uses them inside a character.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: later jobs neither recompute it nor depend on one executor."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of_id(column: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``: the folds of the contracts."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All strings of an Arrow column as one byte array with n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer row stands alone."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task derives from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow, after which the worker gives free memory back: it lives on for the next task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, from 0 to n - 1."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Cumulative polynomial sums; any substring's hash follows from two of them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal bytes give equal hashes, wherever they stand."""
    inverse = powers(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a blank after every row, row of each word, starts, ends)."""
    data = np.insert(data, offsets[1:], 32)
    blank = IS_SPACE[data]
    edge = np.diff(blank.view(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    row = np.searchsorted(offsets[1:] + np.arange(1, len(offsets)), starts, "right")
    return data, row, starts, ends


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Bounds of each of n rows in the sorted array ``rows``."""
    return np.searchsorted(rows, np.arange(n + 1))


def sampled_rows(df: DataFrame, id_col: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of the id: the same rows in every run."""
    return df.orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(bound)
