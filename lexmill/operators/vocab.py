"""Word frequencies, vocabularies and bags of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.cleaning import review_words, split_words, text_or_token
from lexmill.operators.prep import class_of
from lexmill.operators.scale import lookup_join, with_order_index
from lexmill.runtime import materialize, shuffle_partitions

PAD, END, UNKNOWN = 0, 1, 2
SPECIAL_WORDS = ["<pad>", "</s>", "<unk>"]


def class_word_freq(reviews: DataFrame) -> DataFrame:
    """A1: how often each cleaned word occurs in the texts of each class."""
    words = reviews.select(class_of(F.col("Category")).alias("cls"), F.explode(review_words(F.col("text"))).alias("word"))
    return words.groupBy("cls", "word").agg(F.count(F.lit(1)).alias("freq"))


def frequent_words(freqs: DataFrame, threshold: int = 10) -> DataFrame:
    """A2: words seen more than ``threshold`` times."""
    return freqs.where(F.col("freq") > threshold)


def vocab_index(frequent: DataFrame) -> DataFrame:
    """A3: number each class's words from the rarest up, ties by word."""
    return with_order_index(frequent, "idx", [F.col("freq"), F.col("word")], within=["cls"]).select("cls", "word", "idx", "freq")


def build_vocab(reviews: DataFrame, threshold: int = 10) -> DataFrame:
    """A1 to A3 over the training reviews."""
    return materialize(vocab_index(frequent_words(class_word_freq(reviews), threshold)), "vocab")


def bag_of_words(reviews: DataFrame, vocab: DataFrame, clean: bool = False) -> DataFrame:
    """A4, long form: (Id, cls, idx, cnt) for each document and vocabulary word it holds.

    Words are taken from the raw text, so ``好，`` does not match ``好``; ``clean=True`` counts cleaned
    words. Both vocabularies are matched in one pass over the words.
    """
    text = text_or_token(F.col("text"))

    def counted(rows: DataFrame) -> DataFrame:
        words = rows.select("Id", F.explode(review_words(text) if clean else split_words(text)).alias("word"))
        return lookup_join(words, vocab, ["word"]).groupBy("Id", "cls", "idx").agg(F.count(F.lit(1)).alias("cnt"))

    # Texts move once by Id and their words are then counted where they are, which moves less than a row per word. Texts without an Id would all
    # meet in one task, so their words are counted first and move by word.
    docs = reviews.select("Id", "text")
    held = docs.where(F.col("Id").isNotNull()).repartition(shuffle_partitions(reviews.sparkSession), "Id")
    return counted(held).unionByName(counted(docs.where(F.col("Id").isNull())))


def vocab_sizes(vocab: DataFrame) -> DataFrame:
    """A5: words and counted occurrences per class vocabulary; an empty one reports zero."""
    totals = vocab.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("cls") == c, v)), F.lit(0)).alias(f"{n}_{c}")
            for c in ("neg", "pos")
            for n, v in (("words", F.lit(1)), ("tokens", F.col("freq")))
        ]
    )
    return totals.selectExpr("stack(2, 'neg', words_neg, tokens_neg, 'pos', words_pos, tokens_pos) as (cls, n_words, n_tokens)")


def corpus_vocab(texts: DataFrame, text: str | Column, top_n: int) -> DataFrame:
    """(word, token, freq): reserved ids first, then words by falling frequency, ties by word.

    A word spelled like a reserved one takes the reserved id, so no word occurs twice. Only words that are frequent enough to be among
    the first ``top_n``, ties included, are ordered and written.
    """
    column = F.col(text) if isinstance(text, str) else text
    counts = (
        texts.select(F.explode(split_words(F.coalesce(column, F.lit("")))).alias("word"))
        .where(~F.col("word").isin(SPECIAL_WORDS))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("freq"))
        .persist()
    )
    try:
        frequent = counts.where(F.col("freq") >= frequency_cut(counts, top_n))
        ranked = with_order_index(frequent, "rank", [F.desc("freq"), F.col("word")]).where(F.col("rank") < top_n)
        words = ranked.select("word", (F.col("rank") + len(SPECIAL_WORDS)).cast("int").alias("token"), "freq")
        specials = texts.sparkSession.createDataFrame([(w, i, 0) for i, w in enumerate(SPECIAL_WORDS)], words.schema)
        return materialize(specials.unionByName(words), "corpus-vocab")
    finally:
        counts.unpersist()


def frequency_cut(counts: DataFrame, top_n: int) -> int:
    """The lowest frequency among the ``top_n`` most frequent words; 0 if there are no more words than that.

    From a histogram of frequencies: with T words of text it has at most sqrt(2 T) rows, which is what its window sees.
    """
    histogram = counts.groupBy("freq").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("freq")))
    return histogram.withColumn("upto", upto).agg(F.max(F.when(F.col("upto") >= max(1, top_n), F.col("freq")))).first()[0] or 0
