import math
import random

import pytest
from pyspark.sql import functions as F

from lexmill.functions.hashing import unit_hash
from lexmill.operators import candidates as cand
from lexmill.operators import titles
from lexmill.operators.vocab import END
from lexmill.runtime import materialize

SCHEMA = "prev int, next int, cnt bigint, prev_cnt bigint, logp double"


def table(spark, counts):
    totals = {}
    for (p, _), c in counts.items():
        totals[p] = totals.get(p, 0) + c
    return materialize(spark.createDataFrame([(p, n, c, totals[p], math.log(c / totals[p])) for (p, n), c in counts.items()], SCHEMA), "t")


@pytest.fixture(scope="module")
def counts():
    rng = random.Random(5)
    return {(p, n): rng.randint(1, 9) for p in [0, *range(3, 12)] for n in [1, *range(3, 12)] if rng.random() < 0.6}


def by_prev(counts):
    out = {}
    for (p, n), c in counts.items():
        out.setdefault(p, {})[n] = c
    return out


@pytest.mark.parametrize("mode", ["sample", "topk", "topp", "synthesis"])
def test_probabilities_sum_to_one(spark, counts, mode):
    rows = cand.candidates(table(spark, counts), "prev", "next", mode, k=3)
    for r in rows.groupBy("prev").agg(F.sum("p").alias("s"), F.count("*").alias("n")).collect():
        assert r.s == pytest.approx(1) and (r.n <= 3 or mode in ("sample", "topp"))


def scored(spark, probabilities):
    return spark.createDataFrame([(1, i, p) for i, p in enumerate(probabilities)], "g int, token int, p double")


def test_top_p_boundaries(spark):
    def kept(ps, p):
        return [r.token for r in cand.top_p(scored(spark, ps), "g", "token", p).orderBy("token").collect()]

    assert kept([0.7, 0.2, 0.1], 0.6) == [0]
    assert kept([0.4, 0.2, 0.4], 0.8) == [0, 1, 2], "the mass before the last is exactly the limit"
    assert kept([0.4, 0.2, 0.4], 0.6) == [0, 2]
    assert kept([0.25] * 4, 0.3) == [0, 1], "ties by token"


def test_top_k_ties_by_token(spark):
    assert [r.token for r in cand.top_k(scored(spark, [0.25] * 4), "g", "token", 2).orderBy("token").collect()] == [0, 1]


def test_draws_follow_the_weights(spark):
    rows = spark.range(4_000).select(F.col("id").alias("g"), F.explode(F.array(*[F.struct(F.lit(t).alias("token"), F.lit(p).alias("p")) for t, p in ((0, 0.5), (1, 0.3), (2, 0.2))])).alias("x")).select("g", "x.*")
    drawn = {r.token: r["count"] for r in cand.draw(rows, "g", "token", 3).groupBy("token").count().collect()}
    assert sum(drawn.values()) == 4_000
    for token, p in ((0, 0.5), (1, 0.3), (2, 0.2)):
        assert abs(drawn[token] / 4_000 - p) < 0.04


def test_bigrams(spark):
    words = spark.createDataFrame([("<pad>", 0, 0), ("</s>", 1, 0), ("<unk>", 2, 0), ("a", 3, 4), ("b", 4, 2)], "word string, token int, freq bigint")
    texts = spark.createDataFrame([("a b a",), ("a zzz b",), (None,)], "t string")
    got = {(r.prev, r.next): (r.cnt, r.prev_cnt) for r in cand.bigram_table(texts, "t", words).collect()}
    assert got == {(0, 3): (2, 2), (3, 4): (1, 2), (4, 3): (1, 2), (3, 1): (1, 2), (4, 1): (1, 2)}


def greedy(counts, seed, length):
    nexts, path = by_prev(counts), [seed]
    while len(path) < length and path[-1] != END and path[-1] in nexts:
        options = nexts[path[-1]]
        path.append(min(options, key=lambda n: (-options[n], n)))
    return path


@pytest.mark.parametrize("length", [2, 3, 6, 9])
def test_greedy_paths_by_doubling_equal_single_steps(spark, counts, length):
    got = {r.seed: r.path for r in titles.greedy_paths(table(spark, counts), length).collect()}
    assert got == {p: greedy(counts, p, length) for p in by_prev(counts)}


def beam(counts, seed, beams, length, no_repeat):
    nexts = by_prev(counts)
    totals = {p: sum(o.values()) for p, o in nexts.items()}
    step = {(p, n): int(math.floor(math.log(c / totals[p]) * 1e9 + 0.5)) for (p, n), c in counts.items()}
    kept = [(0, [seed])]
    for _ in range(length - 1):
        grown = []
        for score, path in kept:
            pairs = set(zip(path, path[1:]))
            options = [n for n in nexts.get(path[-1], {}) if not (no_repeat and (path[-1], n) in pairs)]
            grown += [(score + step[path[-1], n], [*path, n]) for n in options] or [(score, path)]
        kept = sorted(grown, key=lambda h: (-h[0], h[1]))[:beams]
    return min(kept, key=lambda h: (-h[0] / len(h[1]), h[1]))


@pytest.mark.parametrize("no_repeat", [True, False])
def test_beam_paths_equal_an_exhaustive_beam(spark, counts, no_repeat):
    length = 9
    seeds = spark.createDataFrame([(p,) for p in [0, 3, 4, 5, 6, 99]], "seed int")
    got = {r.seed: (r.score, r.path) for r in titles.beam_paths(table(spark, counts), seeds, 3, length, no_repeat).collect()}
    assert got == {p: beam(counts, p, 3, length, no_repeat) for p in [0, 3, 4, 5, 6, 99]}


def test_a_beam_does_not_repeat_pairs(spark):
    loop = table(spark, {(3, 4): 9, (4, 3): 9, (4, 1): 1, (3, 1): 1})
    path = titles.beam_paths(loop, spark.createDataFrame([(3,)], "seed int"), 4, 10).first().path
    assert len(set(zip(path, path[1:]))) == len(path) - 1


def test_drawn_paths_equal_a_direct_draw(spark, counts):
    scored_rows = cand.candidates(table(spark, counts), "prev", "next", "sample")
    intervals = {}
    for r in cand.cumulative(scored_rows, "prev", "next").collect():
        intervals.setdefault(r.prev, []).append((r.lo, r.hi, r.next))
    docs = spark.range(300).select(F.col("id").cast("string").alias("id"), (3 + F.col("id") % 9).cast("int").alias("seed"))
    got = {r.id: r.path for r in titles.drawn_paths(docs, scored_rows, 6, 4).collect()}
    uniform = {(r.id, r.s): r.u for r in docs.crossJoin(spark.range(1, 6).withColumnRenamed("id", "s")).select("id", "s", unit_hash(4, "id", "s").alias("u")).collect()}
    for doc in docs.collect():
        path = [doc.seed]
        for s in range(1, 6):
            at = math.floor(uniform[doc.id, s] * cand.WHOLE)
            hits = [n for lo, hi, n in intervals.get(path[-1], []) if lo <= at < hi]
            if path[-1] == END or not hits:
                break
            assert len(hits) == 1
            path.append(hits[0])
        assert got[doc.id] == path
    far = titles.drawn_paths(docs, scored_rows, 6, 4, max_rows=0)
    assert {r.id: r.path for r in far.collect()} == got


def test_a_draw_looks_up_one_row_per_word_without_tiers(spark, counts, monkeypatch):
    from lexmill.operators import scale

    def tiers(*_):
        raise AssertionError("the rows of every step would be read twice by the next")

    monkeypatch.setattr(scale, "tiers", tiers)
    monkeypatch.setattr(scale, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(titles, "fits_broadcast", lambda *a: False)
    scored_rows = cand.candidates(table(spark, counts), "prev", "next", "sample")
    docs = spark.range(30).select(F.col("id").cast("string").alias("id"), F.lit(3).alias("seed"))
    assert titles.drawn_paths(docs, scored_rows, 12, 4).count() == 30
    assert titles._guide(scored_rows).count() == len({p for p, _ in counts})


def test_generate_loads_the_model_in_the_task(spark):
    df = spark.createDataFrame([("1", "One. Two."), ("2", "。x"), ("3", None)], "id string, maintext string")
    got = {r.id: r.title for r in titles.generate(df, titles.first_sentence_loader()).collect()}
    assert got == {1: "One", 2: "無", 3: "無"}


def test_a_model_is_loaded_once_per_worker_and_gets_texts_of_like_length(spark, tmp_path):
    folder = str(tmp_path)

    def load(mode):
        import os
        import uuid

        open(f"{folder}/load-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def model(texts):
            assert len(texts) == 1 or len(texts) * max(map(len, texts)) <= 5_000
            return [f"{len(t)} of {mode}" for t in texts]

        return model

    df = spark.range(400).select("id", F.expr("repeat('x', cast(id % 97 as int))").alias("maintext"))
    df = df.union(spark.range(1).select(F.lit(1000).cast("bigint"), F.expr("repeat('long', 12500000)"))).repartition(20)
    found = {r.id: r.title for r in titles.generate(df, load, "greedy", max_bytes=5_000).collect()}
    assert found == {i: f"{i % 97} of greedy" for i in range(400)} | {1000: "50000000 of greedy"}
    loads = [p.name.split("-")[1] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) < 20


def test_texts_that_fail_are_rejected_one_by_one(spark):
    def load(mode):
        def model(texts):
            if any("bad" in t for t in texts):
                raise ValueError("cannot read this")
            return [t.upper() for t in texts]

        return model

    df = spark.createDataFrame([(1, "a"), (2, "bad b"), (3, None), (4, "c"), (4, "bad d")], "id bigint, maintext string")
    found = [(r.id, r.title, r.error) for r in titles.generate(df, load, rejects=True).collect() if r.id != 3]
    reason = "ValueError: cannot read this"
    assert sorted(found, key=str) == sorted([(1, "A", None), (2, None, reason), (4, "C", None), (4, None, reason)], key=str)
    with pytest.raises(Exception, match="cannot read this"):
        titles.generate(df, load).collect()


@pytest.mark.parametrize("case", range(3))
def test_seeds_that_leave_the_beam_early_keep_their_winner(spark, case):
    rng = random.Random(case)
    # Some words nearly always end a title and some nearly never: seeds are decided at different steps, by the bound or by their end.
    counts = {(p, n): rng.choice([1, 1, 5, 400]) for p in range(3, 15) for n in [1, *range(3, 15)] if rng.random() < 0.5}
    seeds = sorted({p for p, _ in counts})
    rows = titles.beam_paths(table(spark, counts), spark.createDataFrame([(p,) for p in seeds], "seed int"), 4, 18)
    assert {r.seed: (r.score, r.path) for r in rows.collect()} == {p: beam(counts, p, 4, 18, True) for p in seeds}


def test_a_seed_is_decided_by_a_finished_title_above_all_open_ones(spark):
    beams = [
        (1, [1, 8, END], -9, True),  # above the open one, average -3
        (1, [1, 9, 9], -40, True),  # reaches -40 / 10 at best
        (2, [2, 8, END], -9, True),
        (2, [2, 9, 9], -20, True),  # may reach -20 / 10
        (3, [3, 8, END], -50, True),  # below the open one
        (3, [3, 9, 9], -40, True),
        (4, [4, 8, END], -50, True),  # none is open
        (4, [4, 9, 9], -40, False),
        (5, [5, 8, END], -12, True),  # an equal average is open to the path
        (5, [5, 9, 9], -40, True),
    ]
    rows = titles._decided(spark.createDataFrame(beams, "seed int, path array<int>, score bigint, open boolean"), 10)
    assert {r.seed: r.decided for r in rows.select("seed", "decided").distinct().collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}
