"""Vectors that take part in similarity operators, and bounded samples of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once


def usable(vector: str) -> Column:
    """True for a vector that is not null or empty, holds finite numbers only, and is not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def of_one_width(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The usable rows whose vectors have the most frequent length (the longest of several), and that length."""
    good = df.where(usable(vector))
    width = good.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return (good.where(F.size(vector) == width.d), width.d) if width else (good, 0)


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, width)


def unit(x: np.ndarray) -> np.ndarray:
    """The rows at length 1; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sample(df: DataFrame, key: str, vector: str, width: int, rows: int, kind: str = "float") -> np.ndarray:
    """At most ``rows`` vectors on the driver, those first by a hash of the key, with components of the given kind."""
    picked = df.select(F.col(key).alias("k"), F.col(vector).cast(f"array<{kind}>").alias("v")).orderBy(F.xxhash64(F.lit(4), "k"), "k").limit(rows)
    return matrix(write_once(picked.select("v"), "sample").toArrow()["v"], width)
