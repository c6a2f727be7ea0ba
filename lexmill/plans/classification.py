"""Train and predict jobs of the review classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.classify import accuracy, class_counts, class_priors, fuse, improving_epochs, predict_labels, scores_by_alpha, text_scores, word_weights
from lexmill.operators.models import fit_two_views, model_scores
from lexmill.operators.prep import union_splits
from lexmill.operators.vocab import bag_of_words, class_word_freq, frequent_words, vocab_index
from lexmill.runtime import materialize
from lexmill.sources.models import load_model, save_model

FREQ_THRESHOLD = 10


def train(spark: SparkSession, train_reviews: DataFrame, dev_reviews: DataFrame, model_dir: str, threshold: int = FREQ_THRESHOLD, **fit) -> DataFrame:
    """Build the vocabularies, fit both views, save the model, and return the accuracy per split."""
    vocab = materialize(vocab_index(frequent_words(class_word_freq(train_reviews), threshold)), "vocab")
    model = fit_two_views(train_reviews, vocab, **fit)
    save_model(model, vocab, model_dir)
    labelled = union_splits(train=train_reviews, dev=dev_reviews)
    right = (F.col("pred") == F.col("Category")).cast("int")
    scored = model_scores(model, labelled).where(F.col("Category").isNotNull())
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def predict(spark: SparkSession, model_dir: str, reviews: DataFrame, on: str = "score") -> DataFrame:
    """(Id, pred) by a saved model. One pass over the reviews; the training data is not read."""
    model, _ = load_model(spark, model_dir)
    return model_scores(model, reviews.select("Id", "text"), on).select("Id", "pred")


def linear_predictions(train_reviews: DataFrame, documents: DataFrame, threshold: int = FREQ_THRESHOLD, on: str = "score") -> DataFrame:
    """C8 with the counted weights of C2: (Id, s0, s1, pred) for every document."""
    freqs = materialize(class_word_freq(train_reviews), "class-word-freq")
    vocab = materialize(vocab_index(frequent_words(freqs, threshold)), "vocab")
    weights = word_weights(class_counts(freqs, vocab))
    scores = text_scores(documents, weights, class_priors(train_reviews))
    return predict_labels(fuse(scores, on))


def choose_epoch(train_reviews: DataFrame, dev_reviews: DataFrame, alphas: list[float], threshold: int = FREQ_THRESHOLD) -> tuple[DataFrame, DataFrame, int]:
    """C7 in training: (class counts, epochs kept, best epoch) for counted weights whose smoothing changes by epoch.

    An epoch is kept if it does better on ``dev_reviews`` than all before it; the last one kept is best.
    """
    freqs = materialize(class_word_freq(train_reviews), "class-word-freq")
    vocab = materialize(vocab_index(frequent_words(freqs, threshold)), "vocab")
    counts = class_counts(freqs, vocab)
    scores = scores_by_alpha(bag_of_words(dev_reviews, vocab), dev_reviews, counts, dict(enumerate(alphas, 1)), class_priors(train_reviews))
    epochs = accuracy(predict_labels(fuse(scores, keys=("epoch", "Id"))), dev_reviews, by=("epoch",))
    kept = materialize(improving_epochs(epochs.select("epoch", "accuracy")), "epochs")
    return counts, kept, kept.agg(F.coalesce(F.max("epoch"), F.lit(1))).first()[0]


def best_predictions(train_reviews: DataFrame, dev_reviews: DataFrame, documents: DataFrame, alphas: list[float]) -> DataFrame:
    """(Id, s0, s1, pred) of the documents by the best epoch of :func:`choose_epoch`."""
    counts, _, best = choose_epoch(train_reviews, dev_reviews, alphas)
    scores = text_scores(documents, word_weights(counts, alphas[best - 1]), class_priors(train_reviews))
    return predict_labels(fuse(scores))


def evaluate(predicted: DataFrame, reviews: DataFrame) -> DataFrame:
    """C5 per split."""
    return accuracy(predicted, reviews)
