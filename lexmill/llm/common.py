"""Helpers that the operators share: words, byte batches, joins back to whole documents."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.scale import fits_broadcast
from lexmill.runtime import materialize

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 1 << 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def fresh(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def attach(docs: DataFrame, extra: DataFrame, key: str = "doc_id") -> DataFrame:
    """Left join of the written table ``extra`` (one row per key, a null key included) to whole documents.

    The result has a document's columns in the struct ``doc``, whatever their names, and the columns of ``extra`` but
    the key. ``extra`` is measured: within the bounds of ``fits_broadcast`` the documents do not move; beyond them
    both sides are shuffled by the key.
    """
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    right = extra.withColumnRenamed(key, "_key")
    right = F.broadcast(right) if fits_broadcast(extra) else right
    return left.join(right, F.col(f"doc.`{key}`").eqNullSafe(F.col("_key")), "left").drop("_key")


def offsets(texts: pa.Array) -> np.ndarray:
    """Where each text starts in its buffer, and where the last one ends."""
    if len(texts) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def pieces(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, starts) for runs of rows with about ``limit`` bytes of text, or one longer row.

    ``starts`` has where each text starts in the bytes, and where the last one ends.
    """
    at, data, first = offsets(texts), texts.buffers()[2] if len(texts) else None, 0
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    while first < len(texts):
        last = min(len(texts), max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1))
        yield first, last, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def gathered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    """All rows of a task; ``schema`` is for a task without any."""
    rows = list(batches)
    return pa.Table.from_batches(rows) if rows else schema.empty_table()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A column of strings without nulls (null: empty)."""
    return batch.column(batch.schema.get_field_index(name)).fill_null("").cast(pa.string())


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A random-looking 64-bit number for each byte value."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of a fixed odd number, modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        step = np.full(max(n, 2 * len(_POWERS)), 0xD6E8FEB86659FD93, np.uint64)
        step[0] = 1
        _POWERS = np.multiply.accumulate(step)
    return _POWERS[:n]


def segment_hashes(codes: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """A 64-bit hash of each run codes[starts[i]:starts[i+1]] (the last run ends at ``total``)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, total))
    place = np.arange(starts[0], total) - np.repeat(starts, lengths)
    sums = np.add.reduceat(codes[starts[0] : total] * powers(int(lengths.max()))[place], starts - starts[0])
    return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task, giving freed memory back to the system after each batch: workers live on through many stages."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                _give_back()

        yield from run(fed())
        _give_back()

    return lean


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several steps read, in the shared folder, and read it back."""
    return materialize(df, name)
