"""Linear scoring as a join, fusion of the two views, and their evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.cleaning import split_words, text_or_token
from lexmill.operators.prep import class_of
from lexmill.operators.scale import lookup_join, with_running_totals
from lexmill.runtime import materialize, sized

VIEWS = ("neg", "pos")


def class_counts(freqs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(cls, word, idx, f0, f1, t0, t1, v): what the weights of a view are made of.

    For each vocabulary word of the view ``cls``, its count in negative and in positive texts, and the
    totals of both and the number of words in the view.
    """
    counts = freqs.groupBy("word").agg(
        *[F.coalesce(F.sum(F.when(F.col("cls") == c, F.col("freq"))), F.lit(0)).alias(f"f{i}") for i, c in enumerate(VIEWS)]
    )
    known = vocab.select("cls", "word", "idx").join(counts, "word")
    sizes = known.groupBy("cls").agg(F.sum("f0").alias("t0"), F.sum("f1").alias("t1"), F.count(F.lit(1)).alias("v"))
    # One row per class.
    return materialize(known.join(F.broadcast(sizes), "cls"), "class-counts")


def word_weights(counts: DataFrame, alpha: float = 1.0) -> DataFrame:
    """Weights for C2 out of class counts: (cls, word, idx, w0, w1).

    ``w0`` and ``w1`` are the log shares, smoothed by ``alpha``, of the word among the vocabulary words of
    the view ``cls`` in negative and in positive texts.
    """
    shares = [(F.col(f"f{i}") + alpha) / (F.col(f"t{i}") + alpha * F.col("v")) for i in (0, 1)]
    return sized(counts.select("cls", "word", "idx", *[F.log(s).alias(f"w{i}") for i, s in enumerate(shares)]), counts)


def class_priors(reviews: DataFrame) -> tuple[float, float]:
    """The smoothed log share of each class among the training reviews: two numbers, so they become literals."""
    positive = (class_of(F.col("Category")) == "pos").cast("int")
    counts = reviews.agg(F.sum(positive).alias("n1"), F.count(F.lit(1)).alias("n"))
    share = (F.coalesce(F.col("n1"), F.lit(0)) + 1) / (F.col("n") + 2)
    return tuple(counts.select(F.log(1 - share), F.log(share)).first())


def linear_scores(bag: DataFrame, documents: DataFrame, weights: DataFrame, bias: tuple[float, float]) -> DataFrame:
    """(Id, view, s0, s1) with s = bias + sum(cnt * weight), for every document and both views.

    A document without any vocabulary word scores its bias. It enters as a zero row of the sum, so the
    one shuffle by document does the work of a left join too.
    """
    terms = lookup_join(bag, sized(weights.select("cls", "idx", "w0", "w1"), weights), ["cls", "idx"]).select(
        "Id", F.col("cls").alias("view"), (F.col("cnt") * F.col("w0")).alias("w0"), (F.col("cnt") * F.col("w1")).alias("w1")
    )
    blank = documents.select("Id", F.explode(F.array(*map(F.lit, VIEWS))).alias("view"), F.lit(0.0).alias("w0"), F.lit(0.0).alias("w1"))
    sums = terms.unionByName(blank).groupBy("Id", "view").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))
    return sums.select("Id", "view", *[(F.col(f"w{i}") + bias[i]).alias(f"s{i}") for i in (0, 1)])


def scores_by_alpha(bag: DataFrame, documents: DataFrame, counts: DataFrame, alphas: dict[int, float], bias: tuple[float, float]) -> DataFrame:
    """C2 for several smoothings at once: (epoch, Id, view, s0, s1), with one look-up and one regrouping of the bag."""
    weights = [F.struct(F.lit(e).alias("epoch"), *[F.log((F.col(f"f{i}") + a) / (F.col(f"t{i}") + a * F.col("v"))).alias(f"w{i}") for i in (0, 1)]) for e, a in alphas.items()]
    wide = materialize(counts.select("cls", "idx", F.array(*weights).alias("weights")), "weights")
    terms = lookup_join(bag, wide, ["cls", "idx"]).select("Id", F.col("cls").alias("view"), "cnt", F.inline("weights"))
    terms = terms.select("epoch", "Id", "view", *[(F.col("cnt") * F.col(f"w{i}")).alias(f"w{i}") for i in (0, 1)])
    blank = documents.select("Id", F.explode(F.array(*map(F.lit, VIEWS))).alias("view"), F.lit(0.0).alias("w0"), F.lit(0.0).alias("w1"))
    blank = blank.select(F.explode(F.array(*map(F.lit, alphas))).alias("epoch"), "*")
    sums = terms.unionByName(blank).groupBy("epoch", "Id", "view").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))
    return sums.select("epoch", "Id", "view", *[(F.col(f"w{i}") + bias[i]).alias(f"s{i}") for i in (0, 1)])


def text_scores(documents: DataFrame, weights: DataFrame, bias: tuple[float, float]) -> DataFrame:
    """C2 straight from the texts, without a bag of words in between: the same (Id, view, s0, s1).

    The weights of both views are looked up at once, and the words of a document are in one task, so the
    sums are all but finished before the one shuffle by document. An unknown word adds nothing. Ids must differ:
    an id that has two first words raises.
    """
    wide = weights.groupBy("word").agg(
        *[F.coalesce(F.sum(F.when(F.col("cls") == v, F.col(w))), F.lit(0.0)).alias(f"{v}_{w}") for v in VIEWS for w in ("w0", "w1")]
    )
    words = documents.select("Id", F.posexplode(split_words(text_or_token(F.col("text")))).alias("pos", "word"))
    hits = lookup_join(words, materialize(wide, "word-weights"), ["word"], "left")
    starts = F.sum((F.col("pos") == 0).cast("int")).alias("_starts")
    sums = hits.groupBy("Id").agg(starts, *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in (f"{v}_{w}" for v in VIEWS for w in ("w0", "w1"))])
    sums = sums.withColumn("Id", F.when(F.col("_starts") == 1, F.col("Id")).otherwise(F.raise_error(F.lit("two documents have one Id")).cast("bigint")))
    views = [F.struct(F.lit(v).alias("view"), *[(F.col(f"{v}_w{i}") + bias[i]).alias(f"s{i}") for i in (0, 1)]) for v in VIEWS]
    return sums.select("Id", F.inline(F.array(*views)))


def fuse(scores: DataFrame, on: str = "score", keys: tuple[str, ...] = ("Id",)) -> DataFrame:
    """The mean of the two views per class, of scores or of their softmax probabilities."""
    if on == "probability":
        positive = 1 / (1 + F.exp(F.col("s0") - F.col("s1")))
        scores = scores.withColumns({"s0": 1 - positive, "s1": positive})
    return scores.groupBy(*keys).agg(F.avg("s0").alias("s0"), F.avg("s1").alias("s1"))


def argmax_label(scores: Column) -> Column:
    """C4 over an array of class scores: the class of the largest, the lowest class among equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def predict_labels(fused: DataFrame) -> DataFrame:
    """C4: add the predicted ``pred`` to fused scores."""
    return fused.withColumn("pred", argmax_label(F.array("s0", "s1")))


def accuracy(predicted: DataFrame, labels: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """The share of labelled documents predicted right, with the counts behind it."""
    known = predicted.join(labels.where(F.col("Category").isNotNull()).select("Id", "Category", "split"), "Id")
    right = (F.col("pred") == F.col("Category")).cast("int")
    return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(right).alias("n_right"), F.avg(right).alias("accuracy"))


def running_mean_loss(losses: DataFrame, within: tuple[str, ...] = ("epoch",)) -> DataFrame:
    """Within an epoch, the sum of the batch losses so far over the batches so far."""
    running = with_running_totals(losses, [F.col("batch")], list(within), loss_sum="loss")
    return running.select(*within, "batch", "loss", (F.col("loss_sum") / F.col("rows_so_far")).alias("running_loss"))


def improving_epochs(epochs: DataFrame, run: tuple[str, ...] = ()) -> DataFrame:
    """Epochs whose accuracy beats every earlier one, starting from 0; the last kept one is best.

    A run has as many rows as epochs, so one task per run is enough.
    """
    earlier = Window.partitionBy(*run).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best = F.coalesce(F.max("accuracy").over(earlier), F.lit(0.0))
    return epochs.withColumn("best_before", best).where(F.col("accuracy") > F.col("best_before"))


def misclassified(predicted: DataFrame, reviews: DataFrame) -> DataFrame:
    """Wrongly predicted documents with their text."""
    return (
        reviews.where(F.col("Category").isNotNull())
        .join(predicted.select("Id", "pred"), "Id")
        .where(F.col("pred") != F.col("Category"))
        .select("Id", "text", "Category", "pred")
    )


def cross_entropy(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """The loss of each document and view: -log softmax(scores)[label]."""
    known = scores.join(labels.where(F.col("Category").isNotNull()).select("Id", "Category", "split"), "Id")
    gap = F.when(F.col("Category") == 0, F.col("s1") - F.col("s0")).otherwise(F.col("s0") - F.col("s1"))
    softplus = F.greatest(gap, F.lit(0.0)) + F.log1p(F.exp(-F.abs(gap)))
    return known.select("Id", "split", "view", softplus.alias("loss"))
