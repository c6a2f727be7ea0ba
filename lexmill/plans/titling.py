"""Prepare, write and score titles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.cleaning import clean_articles
from lexmill.operators.candidates import bigram_table
from lexmill.operators.encode import TITLE_LENGTH, decode, encode, teacher_forcing
from lexmill.operators.evaluate import batch_mean, best_checkpoints, rouge_l, rouge_n, token_nll, units
from lexmill.operators.prep import hash_sample
from lexmill.operators.titles import beam_titles, drawn_titles, greedy_titles, seed_articles
from lexmill.operators.vocab import corpus_vocab
from lexmill.runtime import materialize
from lexmill.sources.stores import append_metrics, read_metrics


@dataclass(frozen=True)
class TitleModel:
    """A vocabulary and the next-word table counted with it."""

    vocab: DataFrame
    bigrams: DataFrame


def train(articles: DataFrame, top_n: int = 32_000) -> TitleModel:
    """Count the vocabulary and the next-word table over the titles."""
    vocab = corpus_vocab(articles, "title", top_n)
    return TitleModel(vocab, bigram_table(articles, "title", vocab))


def seeds(model: TitleModel, articles: DataFrame) -> DataFrame:
    """(id, seed) of the cleaned articles, written: all that a search needs of them, for any number of modes."""
    return seed_articles(clean_articles(articles.select("id", "maintext")), "maintext", model.vocab)


def titles(model: TitleModel, articles: DataFrame, mode: str = "greedy", max_len: int = TITLE_LENGTH, **choice) -> DataFrame:
    """(id, title) for articles in one of the five modes, or ``sample``."""
    return seeded_titles(model, seeds(model, articles), mode, max_len, **choice)


def seeded_titles(model: TitleModel, docs: DataFrame, mode: str = "greedy", max_len: int = TITLE_LENGTH, **choice) -> DataFrame:
    """:func:`titles` for the (id, seed) of :func:`seeds`."""
    if mode == "greedy":
        return greedy_titles(docs, model.bigrams, model.vocab, max_len=max_len)
    if mode == "beam":
        return beam_titles(docs, model.bigrams, model.vocab, max_len=max_len, **choice)
    return drawn_titles(docs, model.bigrams, model.vocab, mode, max_len=max_len, **choice)


def rouge_scores(made: DataFrame, articles: DataFrame, size: int = 4, unit: str = "word") -> DataFrame:
    """One row (rouge_1, rouge_2, rouge_l): means of batch means of F against the true titles."""
    pairs = units(made.select("id", F.col("title").alias("pred")).join(articles.select("id", F.col("title").alias("ref")), "id"), unit)
    one, two, lcs = rouge_n(pairs, 1, unit), rouge_n(pairs, 2, unit), rouge_l(pairs, unit)
    scored = (
        one.select("id", F.col("f").alias("rouge_1"))
        .join(two.select("id", F.col("f").alias("rouge_2")), "id")
        .join(lcs.select("id", F.col("f").alias("rouge_l")), "id")
    )
    return batch_mean(scored.withColumn("id", F.col("id").cast("bigint")), ["rouge_1", "rouge_2", "rouge_l"], size)


def features(model: TitleModel, articles: DataFrame, length: int = TITLE_LENGTH) -> DataFrame:
    """(id, title_ids, decoder_input_ids, decoder_attention_mask, labels) of the titles, written."""
    encoded = encode(articles, model.vocab, "id", {"title_ids": ("title", length)})
    return materialize(teacher_forcing(encoded, "title_ids", length), "title-features")


def decoded_labels(model: TitleModel, made: DataFrame) -> DataFrame:
    """(id, title): what a title is scored against, the decoder input of its :func:`features` as text."""
    return decode(made, model.vocab, "id", "decoder_input_ids")


def validate(model: TitleModel, articles: DataFrame, log: str, step: int, vocab_size: int, share: float = 0.1, max_len: int = TITLE_LENGTH) -> DataFrame:
    """The validation of one checkpoint: (step, v_loss, rouge_1, rouge_2, rouge_l), one row, added to the metric log.

    The loss covers all articles; greedy titles of a sample are scored against the decoded labels. Each value is the mean of batch means.
    """
    made = features(model, articles)
    loss = batch_mean(token_nll(made, model.bigrams, vocab_size).select(F.col("id").cast("bigint").alias("id"), F.col("nll").alias("v_loss")), ["v_loss"])
    sample = hash_sample(articles, "id", share)
    scores = rouge_scores(titles(model, sample, "greedy", max_len), decoded_labels(model, hash_sample(made, "id", share)))
    # Two tables of one row each.
    row = materialize(loss.crossJoin(F.broadcast(scores)).withColumn("step", F.lit(step).cast("bigint")), "validation")
    append_metrics(row, log, ["step"], ["v_loss", "rouge_1", "rouge_2", "rouge_l"])
    return row.select("step", "v_loss", "rouge_1", "rouge_2", "rouge_l")


def best_validated(spark: SparkSession, log: str, keep: int = 3) -> DataFrame:
    """The best checkpoints of a metric log, by loss."""
    values = ["v_loss", "rouge_1", "rouge_2", "rouge_l"]
    return best_checkpoints(read_metrics(spark, log).groupBy("step").pivot("metric", values).agg(F.first("value")), keep)
