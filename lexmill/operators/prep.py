"""Splits, samples, projections and alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.hashing import unit_hash
from lexmill.operators.scale import with_order_index

TRAIN_COLUMNS = ["input_ids", "attention_mask", "decoder_input_ids", "decoder_attention_mask", "labels"]
EVAL_COLUMNS = ["input_ids", "attention_mask", "id"]


def union_splits(**splits: DataFrame) -> DataFrame:
    """Stack the named splits and remember where each row came from."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def class_of(label: Column) -> Column:
    """0 is the negative class, anything else (a missing label too) the positive one."""
    return F.when(label == 0, "neg").otherwise("pos")


def hash_sample(df: DataFrame, id_col: str, fraction: float = 0.1, seed: int = 7) -> DataFrame:
    """A reproducible share of the rows, chosen by a hash of the id."""
    return df.where(unit_hash(seed, id_col) < fraction)


def mode_columns(df: DataFrame, mode: str) -> DataFrame:
    """The columns a mode reads; pruned down to the Parquet scan."""
    return df.select(*(EVAL_COLUMNS if mode == "eval" else TRAIN_COLUMNS))


def numeric_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Digit strings become integers; ANSI mode raises on anything else."""
    return df.withColumn(id_col, F.col(id_col).cast("bigint"))


def pair_views(bag: DataFrame, reviews: DataFrame) -> DataFrame:
    """Both views and the label of each document, one row per document.

    ``bag`` is the long bag of words. Each side of a pair is an array of (idx, cnt), empty for a document
    without any vocabulary word; the label is null where there is none. Rows of ``reviews`` that repeat an Id each get its
    views, and rows without an Id get empty ones.

    The hits are listed by Id, where they are if the bag is in order of Ids, and only the ids and labels of the documents move to them; documents without an Id
    stay where they are.
    """
    hits = bag.where(F.col("Id").isNotNull()).groupBy("Id").agg(F.collect_list(F.struct("cls", "idx", "cnt")).alias("hits"))
    docs = reviews.select("Id", F.col("Category").alias("label"))
    no_hits = F.array().cast(hits.schema["hits"].dataType)
    met = docs.where(F.col("Id").isNotNull()).join(hits, "Id", "left").withColumn("hits", F.coalesce("hits", no_hits))
    full = met.unionByName(docs.where(F.col("Id").isNull()).withColumn("hits", no_hits))

    def view(cls: str) -> Column:
        chosen = F.filter("hits", lambda h: h["cls"] == cls)
        return F.array_sort(F.transform(chosen, lambda h: F.struct(h["idx"].alias("idx"), h["cnt"].alias("cnt")))).alias(cls)

    return full.select("Id", view("pos"), view("neg"), "label")


def assign_batches(
    df: DataFrame, size: int, id_col: str, within: tuple[str, ...] = (), shuffle_seed: int | None = None
) -> DataFrame:
    """Number rows into batches of ``size``, in id order or in a seeded shuffled order.

    The last batch of a group may be short. Pass a narrow frame: its rows are sorted once.
    """
    order = [F.col(id_col)]
    if shuffle_seed is not None:
        order = [unit_hash(shuffle_seed, *within, id_col), *order]
    indexed = with_order_index(df, "_row", order, within)
    return indexed.withColumn("batch", F.floor(F.col("_row") / size)).drop("_row")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
