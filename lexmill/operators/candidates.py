"""Next-word tables and the choice of candidates out of them.

A candidate table has one row per (group, token), so a group is never longer than the vocabulary. That
bound is what makes one window per group safe; all windows here share one shuffle by group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.cleaning import split_words
from lexmill.functions.hashing import unit_hash
from lexmill.operators.scale import lookup_join
from lexmill.operators.vocab import END, PAD
from lexmill.runtime import materialize

# Probabilities are compared and added up as integer parts of this whole: exact in any order of addition.
WHOLE = 10**12
# Log probabilities are added up in units of 1e-9.
LOG_UNIT = 10**9

TEMPERATURE, TOP_K, TOP_P = 0.9, 20, 0.6


def bigram_table(texts: DataFrame, text: str, vocab: DataFrame) -> DataFrame:
    """(prev, next, cnt, prev_cnt, logp) over the texts, as vocabulary ids.

    A text opens with the start id and closes with the end id; pairs with an unknown word are left out.
    Pairs are counted as words first, so only distinct pairs meet the vocabulary.
    """
    words = split_words(F.coalesce(F.col(text), F.lit("")))
    none = F.array(F.lit(None).cast("string"))
    pairs = F.arrays_zip(F.concat(none, words).alias("prev"), F.concat(words, none).alias("next"))
    counts = texts.select(F.explode(pairs).alias("p")).groupBy("p.prev", "p.next").agg(F.count(F.lit(1)).alias("cnt"))
    for side, outer in (("prev", PAD), ("next", END)):
        known = lookup_join(counts.withColumnRenamed(side, "word"), vocab, ["word"], "left")
        counts = known.withColumn(side, F.when(F.col("word").isNull(), outer).otherwise(F.col("token"))).drop("word", "token", "freq")
    counts = counts.where(F.col("prev").isNotNull() & F.col("next").isNotNull()).select("prev", "next", "cnt")
    total = F.sum("cnt").over(Window.partitionBy("prev"))
    counts = counts.withColumn("prev_cnt", total)
    return materialize(counts.withColumn("logp", F.log(F.col("cnt") / F.col("prev_cnt"))), "bigrams")


def softmax(scores: DataFrame, group: str, logit: str = "logp", temperature: float = 1.0) -> DataFrame:
    """G1: add ``p``, the temperature softmax of ``logit`` within each group."""
    whole = Window.partitionBy(group)
    scaled = (F.col(logit) - F.max(logit).over(whole)) / F.lit(float(temperature))
    weighted = scores.withColumn("_e", F.exp(scaled))
    return weighted.withColumn("p", F.col("_e") / F.sum("_e").over(whole)).drop("_e")


def _mass() -> Column:
    return F.round(F.col("p") * WHOLE).cast("bigint")


def _renormalise(kept: DataFrame, group: str) -> DataFrame:
    return kept.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy(group)))


def top_k(scored: DataFrame, group: str, token: str, k: int = TOP_K) -> DataFrame:
    """The ``k`` most likely tokens of each group, renormalised. Spark cuts to ``k`` before the shuffle too."""
    order = Window.partitionBy(group).orderBy(F.desc(_mass()), F.col(token))
    kept = scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
    return _renormalise(kept, group)


def top_p(scored: DataFrame, group: str, token: str, p: float = TOP_P) -> DataFrame:
    """The shortest run of most likely tokens whose mass reaches ``p``, renormalised.

    A token stays if the mass before it is at most ``p``, so the first always does.
    """
    order = Window.partitionBy(group).orderBy(F.desc(_mass()), F.col(token))
    before = F.sum(_mass()).over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = scored.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") <= round(p * WHOLE)).drop("_before")
    return _renormalise(kept, group)


def candidates(
    scores: DataFrame,
    group: str,
    token: str,
    mode: str,
    logit: str = "logp",
    temperature: float = TEMPERATURE,
    k: int = TOP_K,
    p: float = TOP_P,
) -> DataFrame:
    """G4 and the single filters: temperature, then top-k, then top-p on what is left.

    Modes: ``sample`` (unrestricted, temperature 1), ``topk``, ``topp``, ``synthesis`` (both).
    """
    if mode not in ("sample", "topk", "topp", "synthesis"):
        raise ValueError(f"unknown mode {mode!r}")
    scored = softmax(scores, group, logit, 1.0 if mode == "sample" else temperature)
    if mode in ("topk", "synthesis"):
        scored = top_k(scored, group, token, k)
    if mode in ("topp", "synthesis"):
        scored = top_p(scored, group, token, p)
    return scored


def cumulative(scored: DataFrame, group: str, token: str) -> DataFrame:
    """Add the interval [lo, hi) of each token on its group's scale; the last one is open above."""
    order = Window.partitionBy(group).orderBy(F.desc(_mass()), F.col(token))
    hi = F.sum(_mass()).over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead(F.lit(1)).over(order).isNull()
    placed = scored.withColumn("_hi", hi)
    return placed.select(
        "*", (F.col("_hi") - _mass()).alias("lo"), F.when(last, WHOLE + 1).otherwise(F.col("_hi")).cast("bigint").alias("hi")
    ).drop("_hi")


def draw(scored: DataFrame, group: str, token: str, seed: int) -> DataFrame:
    """One token per group by its weight: the first whose cumulative mass exceeds the group's number."""
    at = F.floor(unit_hash(seed, group) * WHOLE)
    return cumulative(scored, group, token).where((F.col("lo") <= at) & (at < F.col("hi"))).drop("lo", "hi")
