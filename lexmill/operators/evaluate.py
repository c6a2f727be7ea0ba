"""Scores of generated titles and of runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.cleaning import split_words
from lexmill.operators.encode import SPECIAL
from lexmill.operators.prep import assign_batches
from lexmill.operators.scale import lookup_join
from lexmill.operators.vocab import END, UNKNOWN
from lexmill.runtime import ROW, materialize, measure, numbered, shuffle_partitions, sized

# Fixed value: stands in for an empty title.
PLACEHOLDER = "無"
BATCH_SIZE = 4
#: Of the words or characters that one task of ROUGE-N spreads out, as :func:`lexmill.runtime.measure` counts them.
TASK_BYTES = 32 << 20


def or_placeholder(title: Column) -> Column:
    """O2: an empty title becomes the placeholder."""
    return F.when(F.length(title) > 0, title).otherwise(PLACEHOLDER)


def _units(text: str, unit: str) -> Column:
    parts = split_words(F.coalesce(F.col(text), F.lit(""))) if unit == "word" else F.split(F.coalesce(F.col(text), F.lit("")), "")
    return F.filter(parts, lambda w: (w != "") & (w != " "))


def _grams(units: Column, n: int) -> Column:
    if n == 1:
        return units
    starts = F.when(F.size(units) >= n, F.sequence(F.lit(1), F.size(units) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(units, i, n), " "))


def f1(hits: Column, n_pred: Column, n_ref: Column) -> Column:
    """The harmonic mean of hits/n_pred and hits/n_ref, 0 if there is no hit."""
    return F.when(hits > 0, 2 * hits / (n_pred + n_ref)).otherwise(F.lit(0.0))


def units(pairs: DataFrame, unit: str = "word") -> DataFrame:
    """The words or characters of pairs (id, pred, ref), numbered and written: what several scores of the same pairs can share."""
    return materialize(numbered(pairs.select("id", _units("pred", unit).alias("p"), _units("ref", unit).alias("r"))), "units")


def rouge_n(pairs: DataFrame, n: int, unit: str = "word") -> DataFrame:
    """O1: (id, overlap, n_pred, n_ref, f) of clipped n-gram overlap for pairs (id, pred, ref), or for their :func:`units`.

    The pairs are numbered and written, so pairs of one id stay pairs; they are moved by number before their
    n-grams are spread out, and both groupings then work in place. There are as many tasks as keep the words of one within ``TASK_BYTES``.
    """
    listed = pairs if ROW in pairs.columns else units(pairs, unit)
    listed = listed.repartition(max(shuffle_partitions(pairs.sparkSession), -(-measure(listed).bytes // TASK_BYTES)), ROW)

    def tagged(side: str, in_pred: int) -> Column:
        return F.transform(_grams(F.col(side), n), lambda g: F.struct(g.alias("gram"), F.lit(in_pred).alias("a"), F.lit(1 - in_pred).alias("b")))

    grams = listed.select(ROW, "id", F.explode_outer(F.concat(tagged("p", 1), tagged("r", 0))).alias("g"))
    counts = grams.groupBy(ROW, "id", "g.gram").agg(F.coalesce(F.sum("g.a"), F.lit(0)).alias("a"), F.coalesce(F.sum("g.b"), F.lit(0)).alias("b"))
    totals = counts.groupBy(ROW, "id").agg(F.sum(F.least("a", "b")).alias("overlap"), F.sum("a").alias("n_pred"), F.sum("b").alias("n_ref"))
    return totals.drop(ROW).withColumn("f", f1(F.col("overlap"), F.col("n_pred"), F.col("n_ref")))


def _lcs_udf(unit: str):
    def lengths(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for preds, refs in batches:
            out = []
            for pred, ref in zip(preds, refs):
                a, b = (
                    t if unit == "listed" else [w for w in (t.split(" ") if unit == "word" else t) if w not in ("", " ")] for t in (pred, ref)
                )
                # Bit-parallel longest common subsequence: a zero bit per matched position of b.
                places: dict[str, int] = {}
                for i, w in enumerate(b):
                    places[w] = places.get(w, 0) | 1 << i
                full = (1 << len(b)) - 1
                row = full
                for w in a:
                    # A word that stands nowhere in b changes nothing.
                    if held := places.get(w):
                        met = row & held
                        row = (row + met | row - met) & full
                out.append(len(b) - row.bit_count())
            yield pd.Series(out, dtype="int64")

    # Annotations are read when the UDF is made, so they are given as objects.
    lengths.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(lengths, "bigint")


def rouge_l(pairs: DataFrame, unit: str = "word") -> DataFrame:
    """O1L: (id, lcs, n_pred, n_ref, f) by longest common subsequence, for texts of any length or for their :func:`units`.

    The subsequence is a recurrence over one pair, with no shuffle; built-in array functions would copy
    a row of the table per step, so an Arrow UDF keeps it as the bits of one integer.
    """
    if ROW in pairs.columns:
        scored = pairs.select("id", _lcs_udf("listed")("p", "r").alias("lcs"), F.size("p").alias("n_pred"), F.size("r").alias("n_ref"))
        return scored.withColumn("f", f1(F.col("lcs"), F.col("n_pred"), F.col("n_ref")))
    texts = pairs.select("id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("pred", "ref")])
    scored = texts.select(
        "id", _lcs_udf(unit)("pred", "ref").alias("lcs"), F.size(_units("pred", unit)).alias("n_pred"), F.size(_units("ref", unit)).alias("n_ref")
    )
    return scored.withColumn("f", f1(F.col("lcs"), F.col("n_pred"), F.col("n_ref")))


def batch_mean(rows: DataFrame, values: Sequence[str], size: int = BATCH_SIZE, id_col: str = "id", weighting: str = "batch") -> DataFrame:
    """O3: one row with the mean of batch means of each value; ``weighting='row'`` for the plain mean."""
    means = [F.avg(v).alias(v) for v in values]
    if weighting == "row":
        return rows.agg(*means)
    return assign_batches(rows.select(id_col, *values), size, id_col).groupBy("batch").agg(*means).agg(*means)


def _step_probability(steps: DataFrame, bigrams: DataFrame, vocab_size: int) -> DataFrame:
    """Add ``p``, the add-one smoothed share of ``next`` among the words seen after ``prev``."""
    context = materialize(bigrams.groupBy("prev").agg(F.max("prev_cnt").alias("prev_cnt")), "contexts")
    seen = lookup_join(lookup_join(steps, sized(bigrams.select("prev", "next", "cnt"), bigrams), ["prev", "next"], "left"), context, ["prev"], "left")
    return seen.withColumn("p", (F.coalesce("cnt", F.lit(0)) + 1) / (F.coalesce("prev_cnt", F.lit(0)) + vocab_size))


def token_nll(features: DataFrame, bigrams: DataFrame, vocab_size: int, key: str = "id") -> DataFrame:
    """(key, n_tokens, nll, perplexity): the mean -log p of the labels that count, each after its decoder input."""
    steps = features.select(key, F.explode(F.arrays_zip(F.col("decoder_input_ids").alias("prev"), F.col("labels").alias("next"))).alias("s"))
    steps = steps.select(key, "s.prev", "s.next").where(F.col("next") != SPECIAL.ignored_label)
    return _mean_nll(steps, bigrams, vocab_size, key)


def text_nll(texts: DataFrame, text: str, vocab: DataFrame, bigrams: DataFrame, vocab_size: int, key: str = "id") -> DataFrame:
    """O4 over whole texts of any length: every word after the one before it, between the start and the end."""
    words = texts.select(key, F.posexplode(split_words(F.coalesce(F.col(text), F.lit("")))).alias("pos", "word"))
    known = lookup_join(words, vocab, ["word"], "left").select(key, "pos", F.coalesce("token", F.lit(UNKNOWN)).alias("token"))
    listed = known.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).getField("token").alias("ids"))
    pairs = F.arrays_zip(F.concat(F.array(F.lit(SPECIAL.pad)), "ids").alias("prev"), F.concat("ids", F.array(F.lit(END))).alias("next"))
    return _mean_nll(listed.select(key, F.inline(pairs)), bigrams, vocab_size, key)


def _mean_nll(steps: DataFrame, bigrams: DataFrame, vocab_size: int, key: str) -> DataFrame:
    scored = _step_probability(steps, bigrams, vocab_size)
    nll = scored.groupBy(key).agg(F.count(F.lit(1)).alias("n_tokens"), F.avg(-F.log("p")).alias("nll"))
    return nll.withColumn("perplexity", F.exp("nll"))


def drawn_loss(features: DataFrame, paths: DataFrame, bigrams: DataFrame, vocab_size: int) -> DataFrame:
    """(id, drawn_loss): the mean -p of the drawn ids, each after the true title's id at its place.

    As in the training step this belongs to, it is the probability and not its logarithm, and pads do not count.
    """
    both = features.select("id", "decoder_input_ids").join(paths.select("id", "path"), "id")
    length = F.least(F.size("decoder_input_ids"), F.size("path"))
    cut = [F.slice(c, F.lit(1), length).alias(n) for c, n in (("decoder_input_ids", "prev"), ("path", "next"))]
    steps = both.select("id", F.explode(F.arrays_zip(*cut)).alias("s")).select("id", "s.prev", "s.next").where(F.col("next") != SPECIAL.pad)
    return _step_probability(steps, bigrams, vocab_size).groupBy("id").agg(F.avg(-F.col("p")).alias("drawn_loss"))


def title_rewards(greedy: DataFrame, drawn: DataFrame, reference: DataFrame) -> DataFrame:
    """(id, greedy, drawn): the ROUGE-L F of the greedy and of the drawn title, both (id, title), in one pass."""
    both = greedy.select("id", F.col("title").alias("greedy")).join(drawn.select("id", F.col("title").alias("drawn")), "id")
    both = both.join(reference.select("id", F.coalesce("title", F.lit("")).alias("ref")), "id")
    lcs, n_ref = _lcs_udf("word"), F.size(_units("ref", "word"))
    return both.select("id", *[f1(lcs(side, "ref"), F.size(_units(side, "word")), n_ref).alias(side) for side in ("greedy", "drawn")])


def batch_rewards(scored: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Per batch of :func:`title_rewards`, the mean F of both kinds and the first minus the second."""
    batches = assign_batches(scored, size, "id").groupBy("batch").agg(F.avg("greedy").alias("greedy_f"), F.avg("drawn").alias("drawn_f"))
    return batches.withColumn("reward", F.col("greedy_f") - F.col("drawn_f"))


def mixed_objective(loss: Column, reward: Column, drawn_loss: Column, ratio: float, epoch: Column, start_epoch: int) -> Column:
    """``(1 - ratio) * loss + ratio * reward * drawn_loss`` in the start epoch, the plain loss elsewhere."""
    if ratio == 0:
        return loss
    return F.when(epoch == start_epoch, (1 - ratio) * loss + ratio * reward * drawn_loss).otherwise(loss)


def best_checkpoints(metrics: DataFrame, keep: int = 3) -> DataFrame:
    """The ``keep`` rows of lowest validation loss, with their formatted names."""
    values = ["v_loss", "rouge_1", "rouge_2", "rouge_l"]
    name = F.format_string(
        "step=%05d-" + "-".join(f"{v}=%.2f" for v in values), F.col("step"), *[F.col(v).cast("double") for v in values]
    )
    return metrics.withColumn("name", name).orderBy("v_loss", "step").limit(keep)
