"""Titles out of a next-word table, for every document at once.

The table does not look at the document beyond its first word. So the deterministic searches run once per
first word, over at most one vocabulary of rows, and the documents then look their title up. Only drawn
titles differ from document to document.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.cleaning import split_words
from lexmill.functions.hashing import unit_hash
from lexmill.operators.candidates import LOG_UNIT, WHOLE, candidates, cumulative
from lexmill.operators.encode import TITLE_LENGTH, decode
from lexmill.operators.evaluate import or_placeholder
from lexmill.operators.scale import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, lookup_join
from lexmill.operators.vocab import END, PAD
from lexmill.runtime import Size, materialize, measure, sized

BEAMS = 8
STEPS_PER_WRITE = 4
#: What a pair of words takes in the three arrays of :func:`_guide`.
GUIDE_BYTES = 20


def seed_articles(articles: DataFrame, text: str, vocab: DataFrame) -> DataFrame:
    """(id, seed): the id of each article's first word, or the start id if the vocabulary lacks it.

    Written, since searches read it more than once and the text above it may be costly to clean.
    """
    word = F.get(split_words(F.coalesce(F.col(text), F.lit(""))), 0)
    seeded = lookup_join(articles.select("id", word.alias("word")), vocab, ["word"], "left")
    return materialize(seeded.select("id", F.coalesce("token", F.lit(PAD)).alias("seed")), "seeded")


def _titles_of_seeds(docs: DataFrame, paths: DataFrame, vocab: DataFrame) -> DataFrame:
    """Decode one title per seed, at most one vocabulary of them, and hand it to the seed's articles."""
    decoded = materialize(decode(paths, vocab, "seed", "path"), "seed-titles")
    return lookup_join(docs, decoded, ["seed"], "left").select("id", or_placeholder(F.col("title")).alias("title"))


def greedy_paths(bigrams: DataFrame, max_len: int) -> DataFrame:
    """(seed, path): from each word, follow the most frequent next word (ties: lowest id) to the end.

    A word has one best successor, so two runs of ``k`` steps join into one of ``2k``: the number of
    joins is the logarithm of the length.
    """
    best = bigrams.groupBy("prev").agg(F.max_by("next", F.struct("cnt", -F.col("next"))).alias("next"))
    runs = materialize(best.select(F.col("prev").alias("seed"), F.array("next").alias("path")), "greedy")
    steps = 1
    while steps < max_len - 1:
        tail = runs.select(F.col("seed").alias("last"), F.col("path").alias("more"))
        open_end = (F.size("path") == steps) & (F.get("path", F.lit(steps - 1)) != END)
        headed = runs.withColumn("last", F.when(open_end, F.get("path", F.lit(steps - 1))))
        joined = lookup_join(headed, tail, ["last"], "left")
        runs = materialize(
            joined.select("seed", F.when(F.col("more").isNotNull(), F.concat("path", "more")).otherwise(F.col("path")).alias("path")), "greedy"
        )
        steps *= 2
    return runs.select("seed", F.slice(F.concat(F.array("seed"), F.col("path")), 1, max_len).alias("path"))


def greedy_titles(docs: DataFrame, bigrams: DataFrame, vocab: DataFrame, max_len: int = TITLE_LENGTH) -> DataFrame:
    """(id, title) of seeded articles by the best next word at every step."""
    # A seed with no successor is a title of one word.
    paths = docs.select("seed").distinct().join(greedy_paths(bigrams, max_len), "seed", "left")
    paths = paths.select("seed", F.coalesce("path", F.array("seed")).alias("path"))
    return _titles_of_seeds(docs, paths, vocab)


def beam_paths(
    bigrams: DataFrame, seeds: DataFrame, beams: int = BEAMS, max_len: int = TITLE_LENGTH, no_repeat: bool = True
) -> DataFrame:
    """(seed, path, score): the best of ``beams`` partial titles kept per seed at every step.

    With ``no_repeat`` no pair of neighbours occurs twice in a title. A title ends with the end id, or
    where no next word is allowed, and is then carried along. Scores are whole multiples of 1e-9.

    At most ``beams`` successors of a partial title can enter the next beam, and its own pairs can bar at
    most ``max_len`` of them. So the best ``beams + max_len`` successors of a word hold every candidate.

    At each write the seeds whose winner is known leave the search, see :func:`_decided`.
    """
    score = F.round(F.col("logp") * LOG_UNIT).cast("bigint")
    order = Window.partitionBy("prev").orderBy(F.desc("step"), F.col("next"))
    ranked = bigrams.select("prev", "next", score.alias("step")).withColumn("_r", F.row_number().over(order))
    nexts = ranked.where(F.col("_r") <= beams + max_len).groupBy(F.col("prev").alias("last"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("step")).alias("back"), "next", "step")))
    nexts = materialize(nexts.agg(F.transform(listed, lambda o: F.struct(o["next"].alias("next"), o["step"].alias("step"))).alias("options")), "beam-nexts")

    none = F.array().cast("array<struct<next:int,step:bigint>>")
    carried = F.array(F.struct(F.lit(None).cast("int").alias("next"), F.lit(0).cast("bigint").alias("step")))
    beam = seeds.select(
        "seed",
        F.array("seed").alias("path"),
        F.lit(0).cast("bigint").alias("score"),
        F.array().cast("array<bigint>").alias("pairs"),
        F.lit(True).alias("open"),
    )
    kept = Window.partitionBy("seed").orderBy(F.desc("score"), F.col("path"))

    def pair(following: Column) -> Column:
        return F.shiftleft(F.col("last").cast("bigint"), 32) + following

    settled: list[DataFrame] = []
    for step in range(1, max_len):
        grown = lookup_join(beam.withColumn("last", F.element_at("path", -1)), nexts, ["last"], "left")
        allowed = F.coalesce("options", none)
        if no_repeat:
            allowed = F.filter(allowed, lambda o: ~F.array_contains(F.col("pairs"), pair(o.next)))
        # The options are in order of score, then id: no more of one partial title can be in the next beam.
        grown = grown.withColumn("allowed", F.slice(allowed, 1, beams)).withColumn("open", F.size("allowed") > 0)
        grown = grown.withColumn("o", F.explode(F.when(F.col("open"), F.col("allowed")).otherwise(carried)))

        def extended(column: str, item: Column) -> Column:
            return F.when(F.col("open"), F.concat(column, F.array(item))).otherwise(F.col(column)).alias(column)

        beam = (
            grown.select(
                "seed",
                extended("path", F.col("o.next")),
                (F.col("score") + F.col("o.step")).alias("score"),
                extended("pairs", pair(F.col("o.next"))),
                "open",
            )
            .withColumn("_r", F.row_number().over(kept))
            .where(F.col("_r") <= beams)
            .drop("_r")
        )
        if step % STEPS_PER_WRITE == 0:
            written = materialize(_decided(beam, max_len), "beam")
            settled.append(written.where("decided"))
            beam = written.where(~F.col("decided")).drop("decided")
            if beam.isEmpty():
                break
    beam = reduce(DataFrame.unionByName, [b.select("seed", "path", "score") for b in [beam, *settled]])
    final = Window.partitionBy("seed").orderBy(F.desc(F.col("score") / F.size("path")), F.col("path"))
    return beam.withColumn("_r", F.row_number().over(final)).where(F.col("_r") == 1).select("seed", "path", "score")


def _decided(beam: DataFrame, max_len: int) -> DataFrame:
    """Add ``decided``: True for seeds whose winner at the end is a finished title they hold now.

    Scores are logarithms of probabilities, so a step adds at most 0: what comes of an open partial title scores at most what that has now, over at
    most ``max_len`` words. A finished title that scores above all open ones keeps its place in the beam. If its average is also
    above that bound, it beats all that is still open, and the finished titles that score no more than an open one as well.
    """
    going = F.col("open") & (F.element_at("path", -1) != END)
    whole = Window.partitionBy("seed")
    reach = F.max(F.when(going, F.col("score"))).over(whole)
    sure = ~going & (F.col("score") > F.col("_reach"))
    best = F.max(F.when(sure, F.col("score") / F.size("path"))).over(whole)
    bounded = beam.withColumn("_reach", reach).withColumn("_best", best)
    # Strictly above: an equal average is settled by the path.
    out = F.col("_reach").isNull() | F.coalesce(F.col("_best") > F.col("_reach") / max_len, F.lit(False))
    return bounded.withColumn("decided", out).drop("_reach", "_best")


def beam_titles(
    docs: DataFrame, bigrams: DataFrame, vocab: DataFrame, beams: int = BEAMS, max_len: int = TITLE_LENGTH, no_repeat: bool = True
) -> DataFrame:
    """G7 with G8: (id, title) of seeded articles by beam search."""
    seeds = materialize(docs.select("seed").distinct(), "seeds")
    return _titles_of_seeds(docs, beam_paths(bigrams, seeds, beams, max_len, no_repeat), vocab)


def _guide(scored: DataFrame) -> DataFrame:
    """(last, n, lows, nexts, firsts): each word's cumulative distribution in one row, indexed for draws (Chen and Asau, 1974).

    The scale of a word with n successors is cut into n equal cells; ``firsts`` has the place of the first interval that meets a cell.
    A draw looks its word up and then sees the intervals of one cell only, fewer than two on average over the draws. A row is
    bounded by the vocabulary, and a pair of words takes a few numbers of the three arrays.
    """
    placed = cumulative(scored, "prev", "next").select("prev", "next", "lo", "hi").where(F.col("lo") < F.col("hi"))
    words = Window.partitionBy("prev")
    placed = placed.withColumn("n", F.count(F.lit(1)).over(words)).withColumn("i", F.row_number().over(words.orderBy("lo")) - 1)
    placed = materialize(placed, "cumulative")

    def cell(at: Column) -> Column:
        return F.least(F.floor(at * F.col("n") / WHOLE), F.col("n") - 1)

    listed = F.array_sort(F.collect_list(F.struct("lo", "next")))
    lists = placed.groupBy("prev", "n").agg(listed.alias("l")).select("prev", "n", F.col("l.lo").alias("lows"), F.col("l.next").alias("nexts"))
    cells = placed.select("prev", "i", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("cell"))
    firsts = cells.groupBy("prev", "cell").agg(F.min("i").alias("i")).groupBy("prev")
    firsts = firsts.agg(F.array_sort(F.collect_list(F.struct("cell", "i"))).getField("i").alias("firsts"))
    guide = materialize(lists.join(firsts, "prev").withColumnRenamed("prev", "last"), "guide")
    return sized(guide, Size(measure(guide).rows, measure(placed).rows * GUIDE_BYTES))


def _pick(at: Column) -> Column:
    """The word whose interval holds ``at``, by the row of :func:`_guide` beside it; null without one."""
    cell = F.least(F.floor(at * F.col("n") / WHOLE), F.col("n") - 1).cast("int")
    first = F.get("firsts", cell)
    # The interval in which the next cell begins may hold the end of this one.
    upto = F.coalesce(F.get("firsts", cell + 1), F.size("lows") - 1)
    met = F.filter(F.slice("lows", first + 1, upto - first + 1), lambda lo: lo <= at)
    return F.get("nexts", first + F.size(met) - 1)


def drawn_paths(
    docs: DataFrame, scored: DataFrame, max_len: int, seed: int, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(id, path): follow words drawn by weight from the seed id of each document in ``docs`` (id, seed).

    Step ``i`` of a document draws with the hash of (seed, id, i), so the titles do not depend on the
    partitioning. The guide is broadcast if its size allows, and then no step moves a document. Beyond that a step is one join by
    word, written at once: no step is planned or run again for the next.
    """
    guide = _guide(scored)
    near = fits_broadcast(guide, max_rows, max_bytes)
    steps_per_write = 2 * STEPS_PER_WRITE if near else 1
    state = docs.select("id", F.array("seed").alias("path"), F.col("seed").alias("last"))
    ended: list[DataFrame] = []
    for step in range(1, max_len):
        at = F.floor(unit_hash(seed, F.col("id"), F.lit(step)) * WHOLE)
        picked = state.join(F.broadcast(guide) if near else guide, "last", "left").select("id", "path", _pick(at).alias("pick"))
        state = picked.select(
            "id",
            F.when(F.col("pick").isNull(), F.col("path")).otherwise(F.concat("path", F.array("pick"))).alias("path"),
            F.when(F.col("pick") != END, F.col("pick")).alias("last"),
        )
        if step % steps_per_write == 0:
            written = materialize(state, "drawn")
            # Ended titles stay where they are written; only the others take part in the next steps.
            ended.append(written.where(F.col("last").isNull()))
            state = written.where(F.col("last").isNotNull())
            if state.isEmpty():
                break
    return reduce(DataFrame.unionByName, [s.select("id", "path") for s in [state, *ended]])


def drawn_titles(
    docs: DataFrame, bigrams: DataFrame, vocab: DataFrame, mode: str, seed: int = 11, max_len: int = TITLE_LENGTH, **choice
) -> DataFrame:
    """G5 over seeded articles: (id, title) in mode ``sample``, ``topk``, ``topp`` or ``synthesis``."""
    paths = drawn_paths(docs, candidates(bigrams, "prev", "next", mode, **choice), max_len, seed)
    # The paths feed one shuffle by document; write them once rather than draw again if a task is lost.
    return decode(materialize(paths, "drawn"), vocab, "id", "path").select("id", or_placeholder(F.col("title")).alias("title"))


def generate(
    articles: DataFrame, load_model: Callable, mode: str = "greedy", text: str = "maintext", rejects: bool = False, max_rows: int = 64, max_bytes: int = 1 << 20
) -> DataFrame:
    """(title, id) by a user's model. ``load_model(mode)`` returns a function from a list of texts to a list of titles.

    It runs once per worker process, which keeps one model from task to task. The model gets texts of like length, at most ``max_rows`` at
    once and, as if each were as long as the longest, at most ``max_bytes``; a longer text comes alone. If it raises, the texts
    are tried one by one. A text that fails alone ends the job, or with ``rejects`` is a row without title that says why in the
    column error (null for the others). Null texts count as empty; rows may repeat an id.
    """
    name = f"title model {uuid.uuid4().hex}"

    def model_of_worker() -> Callable:
        import sys
        import types

        # A module of no file: it lives as long as the worker, which need not have this package.
        held = sys.modules.setdefault("_title_models", types.ModuleType("_title_models")).__dict__
        if name not in held:
            for other in [k for k in held if k.startswith("title model ")]:
                del held[other]
            held[name] = load_model(mode)
        return held[name]

    def parts(texts: list[str]) -> Iterator[list[int]]:
        part: list[int] = []
        for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
            if part and (len(part) == max_rows or (len(part) + 1) * len(texts[i]) > max_bytes):
                yield part
                part = []
            part.append(i)
        if part:
            yield part

    def titles(model: Callable, texts: list[str]) -> tuple[list[str | None], list[str | None]]:
        try:
            made = list(model(texts))
            if len(made) != len(texts):
                raise ValueError(f"{len(made)} titles for {len(texts)} texts")
            return made, [None] * len(texts)
        except Exception as error:
            if len(texts) > 1:
                apart = [titles(model, [t]) for t in texts]
                return [m[0] for m, _ in apart], [e[0] for _, e in apart]
            if not rejects:
                raise
            return [None], [f"{type(error).__name__}: {error}"]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            model, texts = model_of_worker(), batch[text].tolist()
            for part in parts(texts):
                made, errors = titles(model, [texts[i] for i in part])
                yield pd.DataFrame({"title": made, "id": batch["id"].iloc[part].to_numpy(), "error": errors})

    rows = articles.select(F.col("id").cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias(text))
    made = rows.mapInPandas(run, "title string, id bigint, error string")
    title = F.when(F.col("error").isNull(), or_placeholder(F.col("title"))).alias("title")
    return made.select(title, "id", *(["error"] if rejects else []))


def first_sentence_loader() -> Callable:
    """A loader for :func:`generate` that needs no weights: titles are the texts up to their first sentence mark.

    The loader is a local function, which travels to the workers by value: they need not have this package.
    """

    def load(mode: str) -> Callable:
        import re

        mark = re.compile(r"[.!?。！？]")
        return lambda texts: [mark.split(t.strip(), maxsplit=1)[0].strip() for t in texts]

    return load
