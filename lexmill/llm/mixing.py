"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import attach, fresh, word_count, write_once
from lexmill.operators.scale import lookup_join, with_order_index, with_running_totals

#: Expected copies are whole multiples of 2^-24, so that their sums are exact in any order.
UNIT = 1 << 24
SEED = 10


def _name(source: str = "source"):
    """A key without nulls for a source."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(name, source_size, weight, target, place) for each source of ``sizes`` (name, source, size).

    Sources by code point, null last, take the weights in turn and share ``share`` of all sizes by weight. A
    target stops at ``most`` times its source's size; what that leaves over is shared by the others in the same
    way until none is above. Only sums over the sources come to the driver, a pair of numbers each round.
    """
    per = sizes.groupBy("name", "source").agg(F.sum("size").alias("source_size"))
    per = with_order_index(per, "place", [F.col("source").asc_nulls_last()]).drop("source")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    per = write_once(per.withColumn("weight", weight), "sources")
    top = F.col("source_size") * F.lit(float(most))
    total, free = per.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    level, capped = (budget / free if free else 0.0), -1
    while True:
        full = top < F.col("weight") * F.lit(level)
        held, free, n = per.agg(F.sum(F.when(full, top)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if n == capped or not free:
            break
        level, capped = (budget - (held or 0.0)) / free, n
    target = top if not free else F.least(top, F.col("weight") * F.lit(level))
    return per.withColumn("target", target.cast("double"))


def _taken(docs: DataFrame, text: str, key: str, seed: int, same: list[str], **targets) -> DataFrame:
    """(key, name, size, source_size, target, copies) for each row, and the columns ``same`` of ``docs``, by which equal places are ordered."""
    sizes = docs.select(F.col(key).alias("key"), F.col("source").cast("string").alias("source"), _name().alias("name"), word_count(text).alias("size"), *same)
    sizes = write_once(sizes, "sizes")
    per = write_once(source_targets(sizes.select("name", "source", "size"), **targets), "targets")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "name")), 1, 6), 16, 10).cast("bigint")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = write_once(per.withColumn("units", F.floor(rate * UNIT).cast("bigint")).withColumn("offset", offset), "rates")
    rows = lookup_join(sizes.drop("source"), per, ["name"])
    order = ["size", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))), "key", *same]
    summed = with_running_totals(rows, [F.col(c) if isinstance(c, str) else c for c in order], ["place"], upto="units")
    after = F.shiftright(F.col("upto") + F.col("offset"), 24)
    before = F.shiftright(F.col("upto") - F.col("units") + F.col("offset"), 24)
    return summed.select("key", "name", "size", "source_size", "target", (after - before).cast("bigint").alias("copies"), *same)


def copies(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, **targets) -> DataFrame:
    """(key, size, source_size, target, copies) for each row of ``docs`` (key, source, text).

    Each document of a source is expected target / source_size times. The expected copies are summed up along
    the source, in the order of size (then a hash of the key), one offset per source is added, and a document
    is taken once per whole number that its own part of the sum crosses. With neighbours of like size the words
    taken come near the target, and none is taken more than ``most`` (2) times. The sum over a source of any size is
    made per slice of the sorted rows plus what earlier slices carry over. Null text has size 0. A
    source with no words is expected 0 times. Repeated rows count as documents of their own. Empty input gives no rows.
    """
    return _taken(docs, text, key, seed, [], **targets).select(F.col("key").alias(key), "size", "source_size", "target", "copies")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = SEED, **targets) -> DataFrame:
    """The documents of the mix, each as often as :func:`copies` says, with the columns of ``docs``.

    Rows that repeat a key, or have none, are told apart by a hash of all their columns; equal rows share their copies evenly, and
    what is left over goes to the first of them, so the copies add up to those of :func:`copies`.
    """
    row = fresh(docs, "_row")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    taken = write_once(_taken(docs.withColumn(row, whole), text, key, seed, [row], **targets), "taken")
    per = taken.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), F.sum("copies").cast("int").alias("_copies"))
    per = write_once(per.withColumnRenamed("key", key), "copies")
    alone = F.col(key).isNotNull() & (F.col("_rows") == 1)
    full = attach(docs, per.withColumn("_alone", alone), key)
    times = lambda n: F.explode(F.when(n > 0, F.sequence(F.lit(1), n)))
    mixed = full.where("_alone").select("doc", times(F.col("_copies")))
    if not per.where(~alone).isEmpty():
        again = full.where(~F.col("_alone")).select("doc").withColumn("_row", F.xxhash64(*[F.col(f"doc.`{c}`") for c in docs.columns]))
        sums = taken.groupBy(F.col(row).alias("_row")).agg(F.sum("copies").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        again = lookup_join(again, write_once(sums, "row-copies"), ["_row"])
        left = F.col("_sum") % F.col("_n")
        even = again.where(left == 0).select("doc", times((F.col("_sum") / F.col("_n")).cast("int")))
        odd = with_order_index(again.where(left > 0), "_at", [F.col("_row")], ["_row"])
        share = F.floor(F.col("_sum") / F.col("_n")) + F.when(F.col("_at") < left, 1).otherwise(0)
        mixed = mixed.union(even).union(odd.select("doc", times(share.cast("int"))))
    return mixed.select("doc.*")
