"""Seeded, order-free pseudo-random numbers that any SQL engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(seed: int, *keys: Column | str) -> Column:
    """A double in [0, 1) from the first 32 bits of ``md5('seed:key[:key…]')``.

    Unlike ``rand(seed)`` the value depends on the keys only, so a retried task or another
    partitioning draws the same numbers.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
