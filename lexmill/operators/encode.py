"""Fixed-length token arrays and teacher-forcing labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.cleaning import clean_articles, split_words
from lexmill.operators.prep import mode_columns, numeric_id
from lexmill.operators.scale import list_lookup, lookup_join
from lexmill.operators.vocab import END, PAD, UNKNOWN
from lexmill.runtime import ROW, materialize, numbered


@dataclass(frozen=True)
class SpecialIds:
    """Ids with a meaning, and the label that a loss skips."""

    pad: int = 0
    leading_space: int = 259
    ignored_label: int = -100


SPECIAL = SpecialIds()
TEXT_LENGTH = 512
TITLE_LENGTH = 64


def close_and_pad(ids: Column, length: int) -> Column:
    """Append the end id, keeping it when the ids are cut, and fill up with pads."""
    closed = F.concat(F.slice(ids, 1, length - 1), F.array(F.lit(END)), F.array_repeat(F.lit(PAD), length))
    return F.slice(closed, 1, length)


def token_mask(ids: Column) -> Column:
    """1 on real tokens, 0 on pads."""
    return F.transform(ids, lambda i: (i != PAD).cast("int"))


def encode(df: DataFrame, vocab: DataFrame, key: str, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Ids of the words of several text columns, ``{out: (text column, length)}``.

    Only the words that fit the fixed length leave a row: ``length - 1``, since the end id needs a place.
    With a vocabulary within the bounds of a broadcast the words are looked up where they are, list by list. Else all
    columns share one look-up and one regrouping, and rows are told apart by a number that is written with
    their words. Rows of one ``key`` stay rows.
    """
    if lookup := list_lookup(vocab, "word", "token", missing=UNKNOWN):

        def ids_in_place(text: str, length: int) -> Column:
            return close_and_pad(lookup(F.slice(split_words(F.coalesce(F.col(text), F.lit("")), length), 1, length - 1)), length)

        return df.select(key, *[ids_in_place(text, length).alias(out) for out, (text, length) in columns.items()])
    fields = F.array(
        *[
            F.struct(F.lit(out).alias("field"), F.slice(split_words(F.coalesce(F.col(text), F.lit(""))), 1, length - 1).alias("words"))
            for out, (text, length) in columns.items()
        ]
    )
    # The array is a column of its own, so that its rows do not each carry a copy of it.
    listed = materialize(numbered(df.select(key, fields.alias("fields"))), "cut-words").select(ROW, key, F.inline("fields"))
    words = listed.select(ROW, key, "field", F.posexplode("words").alias("pos", "word"))
    known = lookup_join(words, vocab, ["word"], "left")
    known = known.withColumn("token", F.coalesce("token", F.lit(UNKNOWN)))

    def ids(out: str, length: int) -> Column:
        placed = F.array_sort(F.collect_list(F.when(F.col("field") == out, F.struct("pos", "token"))))
        return close_and_pad(placed.getField("token"), length).alias(out)

    return known.groupBy(ROW, key).agg(*[ids(out, length) for out, (_, length) in columns.items()]).drop(ROW)


def decoder_start(ids: Column, length: int, special: SpecialIds = SPECIAL) -> Column:
    """The start id takes the place of a leading space, or else pushes the last id out."""
    start = F.array(F.lit(special.pad))
    return F.when(F.get(ids, 0) == special.leading_space, F.concat(start, F.slice(ids, 2, length - 1))).otherwise(
        F.concat(start, F.slice(ids, 1, length - 1))
    )


def teacher_forcing(df: DataFrame, title_ids: str, length: int, special: SpecialIds = SPECIAL) -> DataFrame:
    """Decoder inputs, their mask, and labels shifted by one with pads ignored.

    The mask is that of the ids before the start id is put in.
    """
    y = decoder_start(F.col(title_ids), length, special)
    df = df.withColumn("_y", y)
    labels = F.transform(F.slice("_y", 2, length - 1), lambda i: F.when(i == special.pad, special.ignored_label).otherwise(i))
    return (
        df.withColumn("decoder_input_ids", F.slice("_y", 1, length - 1))
        .withColumn("decoder_attention_mask", F.slice(token_mask(F.col(title_ids)), 1, length - 1))
        .withColumn("labels", labels)
        .drop("_y")
    )


def decode(df: DataFrame, vocab: DataFrame, key: str, ids: str, out: str = "title") -> DataFrame:
    """Ids back to text without the reserved ids; nothing left gives an empty string. Rows of one key stay rows."""
    real = F.filter(F.col(ids), lambda i: i > UNKNOWN)
    listed = materialize(numbered(df.select(key, real.alias("ids"))), "real-ids")
    placed = listed.select(ROW, key, F.posexplode_outer("ids").alias("pos", "token"))
    words = lookup_join(placed, vocab, ["token"], "left")
    ordered = F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("pos", "word"))))
    return words.groupBy(ROW, key).agg(F.array_join(ordered.getField("word"), " ").alias(out)).drop(ROW)


def build_features(
    articles: DataFrame,
    vocab: DataFrame,
    mode: str,
    text_length: int = TEXT_LENGTH,
    title_length: int = TITLE_LENGTH,
    keep_id: bool = False,
) -> DataFrame:
    """E5: cleaned articles to the columns of a mode: ``train``, ``validation`` or ``eval``."""
    cleaned = clean_articles(articles)
    columns = {"input_ids": ("maintext", text_length)}
    if mode != "eval":
        columns["title_ids"] = ("title", title_length)
    encoded = encode(cleaned, vocab, "id", columns).withColumn("attention_mask", token_mask(F.col("input_ids")))
    if mode == "eval":
        return mode_columns(numeric_id(encoded), mode)
    forced = teacher_forcing(encoded, "title_ids", title_length)
    return forced.drop("title_ids") if keep_id else mode_columns(forced, mode)


def map_features(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """A user's batch function over Arrow batches, in parallel on every partition.

    ``fn`` takes and returns a pandas DataFrame. The session's ``spark.sql.execution.arrow.maxRecordsPerBatch``
    sets the batch size.
    """

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)
