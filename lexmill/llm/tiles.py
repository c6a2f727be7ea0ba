"""Buckets of any size as tiles of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once
from lexmill.operators.scale import lookup_join

TILE = 4096


def tiles(rows: DataFrame, size: int = TILE) -> DataFrame:
    """``rows`` (t, bucket, node and more) with the columns ``own`` and ``tile``: buckets above ``size`` are cut into chunks.

    ``own`` is the row's chunk. Each pair of chunks is a tile, so every pair of rows of a bucket meets in a tile, and no
    tile has more than about 2 * ``size`` rows whatever the bucket's size. Rows of different chunks meet once.
    """
    hot = rows.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size)
    hot = write_once(hot.select("t", "bucket", F.ceil(F.col("n") / size).cast("int").alias("chunks")), "hot-buckets")
    if hot.isEmpty():
        return rows.withColumns({"own": F.lit(0).cast("bigint"), "tile": F.lit(0).cast("bigint")})
    cut = lookup_join(rows, hot, ["t", "bucket"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("bigint")
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)).cast("array<bigint>"))
    cut = cut.withColumn("own", F.coalesce(own, F.lit(0))).select("*", other.alias("other"))
    return cut.select(*rows.columns, "own", (F.least("own", "other") * (1 << 31) + F.greatest("own", "other")).alias("tile"))
