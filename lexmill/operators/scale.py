"""Total orders, running totals and look-up joins that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.runtime import materialize, measure, shuffle_partitions

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20
#: Part of the left rows that tells which keys are frequent, and the keys that are looked at.
SAMPLE = 0.05
HEAD_KEYS = 100_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if the measured rows and bytes of ``df`` are both within the bounds."""
    size = measure(df)
    return size.rows <= max_rows and size.bytes <= max_bytes


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a big ``left`` to a table of look-ups.

    ``right`` is measured: pass a materialised table, and the same object again in a loop. Within the bounds it is broadcast and ``left``
    does not move. Beyond them the look-up has two tiers, see :func:`tiers`: rows with a frequent key meet a broadcast
    head of ``right`` (or are known to have no match), and only the others are shuffled. Frequent keys
    come from a sample, which decides where rows travel and never which rows match. Rows without a key match nothing.
    """
    on = list(on)
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on, how)
    near, head, far, tail = tiers(left, right, on, max_rows, max_bytes)
    shuffled = far.join(tail, [*on, "_salt"], how).drop("_salt")
    return shuffled if near is None else near.join(F.broadcast(head), on, how).unionByName(shuffled)


def list_lookup(
    table: DataFrame, key: str, value: str, missing: int | None = None, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> Callable[[Column], Column] | None:
    """The look-up of whole arrays: ``lookup(words)`` has the int ``value`` of each word of an array at its place, or ``missing`` where ``table`` lacks the word.

    As the broadcast side of :func:`lookup_join`, within the same bounds, but the arrays stay whole: no row per word is made, moved and regrouped.
    None if ``table`` is beyond the bounds, or has a key twice, or a null key or value: then only a join tells all. Pass a written table.
    """
    if not fits_broadcast(table, max_rows, max_bytes):
        return None
    held = table.select(F.col(key).alias("key"), F.col(value).cast("int").alias("value")).toArrow().combine_chunks()
    if held["key"].null_count or held["value"].null_count or len(held["key"].unique()) < len(held):
        return None
    shared = table.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("array<int>")
    def lookup(words: pa.Array) -> pa.Array:
        keys, values = shared.value["key"].combine_chunks(), shared.value["value"].combine_chunks()
        flat = words.flatten()
        found = values.take(pc.index_in(flat.cast(keys.type), keys)) if len(keys) else pa.nulls(len(flat), pa.int32())
        return pa.ListArray.from_arrays(list_offsets(words), found if missing is None else pc.fill_null(found, missing))

    return lookup


def list_offsets(lists: pa.Array) -> pa.Array:
    """Where each list starts in ``lists.flatten()``, and the end; a null has no items."""
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32()))
    return pa.concat_arrays([pa.array([0], pa.int32()), ends])


def tiers(left: DataFrame, right: DataFrame, on: list[str], max_rows: int, max_bytes: int) -> tuple[DataFrame | None, DataFrame | None, DataFrame, DataFrame]:
    """(near, head, far, tail): rows of ``left`` whose key is in the head, the rows of ``right`` for these, and the rest of both, salted.

    The head takes the most frequent keys of a sample of ``left``, as long as their rows of ``right`` stay within the bounds; keys
    that ``right`` lacks cost it nothing but their name, which counts as a row. Of the other frequent keys each is spread over as many salts as it
    has times an even task's share of the sample, its ``right`` rows repeated once per salt.
    """
    parts = shuffle_partitions(left.sparkSession)
    seen = left.select(*on).dropna().sample(SAMPLE, 17).groupBy(*on).agg(F.count(F.lit(1)).alias("_seen"))
    seen = materialize(seen.orderBy(F.desc("_seen"), *on).limit(HEAD_KEYS), "frequent-keys")
    total = seen.agg(F.coalesce(F.sum("_seen"), F.lit(0))).first()[0]
    size = measure(right)
    room = min(max_rows, max_bytes * size.rows // max(1, size.bytes))
    held = right.join(F.broadcast(seen.select(*on)), on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum(F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1))).over(Window.orderBy(F.desc("_seen"), *on))
    keys = materialize(seen.join(held, on, "left").withColumn("_upto", upto), "head-keys")
    chosen = keys.where(F.col("_upto") <= room).select(*on, F.lit(True).alias("_near"))
    head = materialize(right.join(F.broadcast(chosen.drop("_near")), on, "left_semi"), "head") if room > 0 else None
    marks = keys.where(F.col("_upto") > room) if head is not None and fits_broadcast(head, max_rows, max_bytes) else keys
    near = None
    if marks is not keys:
        marked = left.join(F.broadcast(chosen), on, "left")
        near, left = marked.where("_near").drop("_near"), marked.where(F.col("_near").isNull()).drop("_near")
    salts = F.ceil(F.col("_seen") * parts / max(1, total)).cast("int")
    hot = materialize(marks.select(*on, salts.alias("_salts")).where(F.col("_salts") > 1), "hot-keys")
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.when(no_key, F.lit(parts)).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int")
    far = left.join(F.broadcast(hot), on, "left").withColumn("_salt", spread).drop("_salts")
    tail = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return near, head, far, tail


def _slices(df: DataFrame, within: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Range-partition and sort by (within, order_by), and write each row's slice and position.

    The table is written because the sampled range bounds differ between two runs of one plan, while the
    positions and the per-slice totals must come from the same run.
    """
    keys = [F.col(c) for c in within] + list(order_by)
    placed = df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    return materialize(
        placed.select("*", F.spark_partition_id().alias("_slice"), F.monotonically_increasing_id().alias("_pos")), "slices"
    )


def _join_slices(slices: DataFrame, starts: DataFrame, within: Sequence[str]) -> DataFrame:
    # Without groups there is one row per slice, which bounds the broadcast by the number of partitions.
    if not within:
        return slices.join(F.broadcast(starts), "_slice")
    return lookup_join(slices, materialize(starts, "starts"), ["_slice", *within])


def _before(within: Sequence[str]):
    return Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def with_order_index(df: DataFrame, index: str, order_by: Sequence[Column], within: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order_by``, counted per ``within`` group.

    For groups of any size, few in number (classes, splits, runs). Rows are sorted once in parallel; a
    row's index is its position in its slice plus the rows of its group in earlier slices. The window
    runs over one row per (slice, group).
    """
    slices = _slices(df, within, order_by)
    starts = slices.groupBy("_slice", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_n").over(_before(within)), F.lit(0))).drop("_n")
    placed = _join_slices(slices, starts, within)
    return placed.withColumn(index, F.col("_start") + F.col("_pos") - F.col("_first")).drop("_slice", "_pos", "_first", "_start")


def with_running_totals(df: DataFrame, order_by: Sequence[Column], within: Sequence[str], **totals: str) -> DataFrame:
    """Add running sums (``total_name="column"``) and the running row count ``rows_so_far``.

    The same two levels as :func:`with_order_index`: a local window per (slice, group), plus what earlier
    slices carry over.
    """
    slices = _slices(df, within, order_by)
    parts = slices.groupBy("_slice", *within).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(source).alias(f"_sum_{name}") for name, source in totals.items()]
    )
    carried = {"rows_so_far": "_n", **{name: f"_sum_{name}" for name in totals}}
    starts = parts.select(
        "_slice", *within, *[F.coalesce(F.sum(c).over(_before(within)), F.lit(0)).alias(f"_carry_{n}") for n, c in carried.items()]
    )
    local = Window.partitionBy("_slice", *within).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    running = slices.withColumn("rows_so_far", F.count(F.lit(1)).over(local))
    for name, source in totals.items():
        running = running.withColumn(name, F.sum(source).over(local))
    running = _join_slices(running, starts, within)
    for name in carried:
        running = running.withColumn(name, F.col(name) + F.col(f"_carry_{name}")).drop(f"_carry_{name}")
    return running.drop("_slice", "_pos")
