import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmill.operators import evaluate


def pairs(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, pred string, ref string")


def plain_f(hits, n, m):
    return 2 * hits / (n + m) if hits else 0.0


def plain_rouge(pred, ref, n):
    a, b = ([w for w in t.split(" ") if w] for t in (pred, ref))
    grams = [Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (a, b)]
    return plain_f(sum((grams[0] & grams[1]).values()), sum(grams[0].values()), sum(grams[1].values()))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


FIXED = [("a b c", "a b c"), ("a b", "c d"), ("", ""), ("a", ""), ("", "b"), ("a a a b", "a b a"), ("x", "x y"), ("b a", "a  b")]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return FIXED + [tuple(" ".join(rng.choices("abcde", k=rng.randint(0, 90))) for _ in range(2)) for _ in range(40)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_rouge_n(spark, rows, n):
    got = {r.id: r.f for r in evaluate.rouge_n(pairs(spark, rows), n).collect()}
    assert got == {i: pytest.approx(plain_rouge(*r, n)) for i, r in enumerate(rows)}


def test_rouge_l(spark, rows):
    got = {r.id: r for r in evaluate.rouge_l(pairs(spark, rows)).collect()}
    for i, (pred, ref) in enumerate(rows):
        a, b = ([w for w in t.split(" ") if w] for t in (pred, ref))
        assert got[i].lcs == plain_lcs(a, b)
        assert got[i].f == pytest.approx(plain_f(plain_lcs(a, b), len(a), len(b)))


def test_rouge_of_characters(spark):
    got = evaluate.rouge_n(pairs(spark, [("台北 市", "台北市政")]), 1, "char").first()
    assert (got.overlap, got.n_pred, got.n_ref) == (3, 3, 4)
    assert evaluate.rouge_l(pairs(spark, [("台北 市", "台市北")]), "char").first().lcs == 2


def test_f_is_symmetric(spark, rows):
    swapped = [(b, a) for a, b in rows]
    for score in (lambda p: evaluate.rouge_n(p, 2), evaluate.rouge_l):
        assert {r.id: r.f for r in score(pairs(spark, rows)).collect()} == {r.id: r.f for r in score(pairs(spark, swapped)).collect()}


def test_placeholder(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(evaluate.or_placeholder(F.col("t"))).collect()] == ["無", "無", "x"]


def test_short_last_batch_weighs_as_much(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 5])], "id int, v double")
    assert evaluate.batch_mean(df, ["v"], 4).first().v == 3.0
    assert evaluate.batch_mean(df, ["v"], 4, weighting="row").first().v == pytest.approx(1.8)


BIGRAMS = [(0, 3, 2, 2, 0.0), (3, 4, 1, 3, 0.0), (3, 1, 2, 3, 0.0)]


def test_token_nll(spark):
    grams = spark.createDataFrame(BIGRAMS, "prev int, next int, cnt bigint, prev_cnt bigint, logp double")
    features = spark.createDataFrame([(1, [0, 3, 4], [3, 4, -100]), (2, [0, 9, 1], [9, 1, -100])], "id int, decoder_input_ids array<int>, labels array<int>")
    got = {r.id: r for r in evaluate.token_nll(features, grams, 10).collect()}
    assert got[1].nll == pytest.approx(-(math.log(3 / 12) + math.log(2 / 13)) / 2)
    assert got[2].nll == pytest.approx(-(math.log(1 / 12) + math.log(1 / 10)) / 2)
    assert got[1].n_tokens == 2 and got[1].perplexity == pytest.approx(math.exp(got[1].nll))
    paths = spark.createDataFrame([(1, [3, 1]), (2, [0, 3])], "id int, path array<int>")
    loss = {r.id: r.drawn_loss for r in evaluate.drawn_loss(features, paths, grams, 10).collect()}
    assert loss[1] == pytest.approx(-(3 / 12 + 3 / 13) / 2) and loss[2] == pytest.approx(-1 / 10)


def test_rewards_and_objective(spark):
    made = [spark.createDataFrame(list(enumerate(t)), "id int, title string") for t in (["a b", "c"], ["a x", "q"], ["a b", "c d"])]
    rows = evaluate.batch_rewards(evaluate.title_rewards(*made), 2).collect()
    assert rows[0].reward == pytest.approx((1 + 2 / 3) / 2 - 0.25)
    df = spark.createDataFrame([(20, 2.0), (21, 2.0)], "epoch int, loss double")
    mixed = evaluate.mixed_objective(F.col("loss"), F.lit(0.5), F.lit(-0.1), 0.3, F.col("epoch"), 20)
    assert [r[0] for r in df.select(mixed).collect()] == [pytest.approx(0.7 * 2 - 0.3 * 0.05), 2.0]
    assert [r[0] for r in df.select(evaluate.mixed_objective(F.col("loss"), F.lit(1.0), F.lit(1.0), 0, F.col("epoch"), 20)).collect()] == [2.0, 2.0]


def test_best_checkpoints(spark):
    df = spark.createDataFrame([(s, v, 0.1, 0.2, 0.3) for s, v in ((1, 3.0), (2, 1.0), (3, 2.0), (4, 1.5), (5, 1.0))], "step bigint, v_loss double, rouge_1 double, rouge_2 double, rouge_l double")
    rows = evaluate.best_checkpoints(df).collect()
    assert [r.step for r in rows] == [2, 5, 4]
    assert rows[0].name == "step=00002-v_loss=1.00-rouge_1=0.10-rouge_2=0.20-rouge_l=0.30"


def test_pairs_of_one_id_stay_pairs(spark):
    pairs = spark.createDataFrame([(1, "a b", "a b"), (1, "c", "d")], "id bigint, pred string, ref string")
    assert sorted((r.id, r.overlap, r.n_pred) for r in evaluate.rouge_n(pairs, 1).collect()) == [(1, 0, 1), (1, 2, 2)]


def test_a_task_of_rouge_n_spreads_out_bounded_words(spark, rows, monkeypatch):
    whole = {tuple(r) for r in evaluate.rouge_n(pairs(spark, rows), 2, "char").collect()}
    monkeypatch.setattr(evaluate, "TASK_BYTES", 20_000)
    parts = evaluate.rouge_n(pairs(spark, rows), 2, "char")
    assert parts.rdd.getNumPartitions() > 8 and {tuple(r) for r in parts.collect()} == whole


def test_scores_of_the_same_units_write_them_once(spark, rows, monkeypatch):
    scores = [lambda p, u: evaluate.rouge_n(p, 1, u), lambda p, u: evaluate.rouge_n(p, 2, u), evaluate.rouge_l]
    texts = pairs(spark, [*rows, ("台北 市", "台市北")])
    for unit in ("word", "char"):
        want = [sorted(map(tuple, score(texts, unit).collect())) for score in scores]
        listed = evaluate.units(texts, unit)
        with monkeypatch.context() as m:
            m.setattr(evaluate, "materialize", None)
            assert [sorted(map(tuple, score(listed, unit).collect())) for score in scores] == want
