import math
import shutil

import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from lexmill.functions.cleaning import split_words, text_or_token
from lexmill.operators import classify, models, prep, vocab
from lexmill.plans import classification
from lexmill.runtime import materialize
from lexmill.sources.models import load_model, save_model

REVIEWS = "Id bigint, Category int, text string"


def reviews(spark, rows):
    return spark.createDataFrame(rows, REVIEWS)


def test_class_of(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "c int")
    assert [r[0] for r in df.select(prep.class_of(F.col("c"))).collect()] == ["neg", "pos", "pos", "pos"]


def test_threshold_is_strict_and_ties_go_by_word(spark):
    text = " ".join(["ten"] * 10 + ["b"] * 11 + ["a"] * 11 + ["most"] * 12)
    words = vocab.build_vocab(reviews(spark, [(1, 0, text), (2, 1, "x")]))
    assert [(r.cls, r.word, r.idx, r.freq) for r in words.orderBy("idx").collect()] == [("neg", "a", 0, 11), ("neg", "b", 1, 11), ("neg", "most", 2, 12)]
    assert [tuple(r) for r in vocab.vocab_sizes(words).orderBy("cls").collect()] == [("neg", 3, 34), ("pos", 0, 0)]


def test_bag_counts_raw_words_of_every_document(spark):
    words = spark.createDataFrame([("neg", "好", 0, 20), ("pos", "好", 3, 20), ("pos", "nan", 1, 11), ("pos", "", 2, 11)], "cls string, word string, idx bigint, freq bigint")
    docs = reviews(spark, [(1, 0, "好， 好 好"), (2, 1, None), (3, None, "zzz"), (4, 1, "a  b")])
    bag = {tuple(r) for r in vocab.bag_of_words(docs, words).collect()}
    assert bag == {(1, "neg", 0, 2), (1, "pos", 3, 2), (2, "pos", 1, 1), (4, "pos", 2, 1)}
    clean = {tuple(r) for r in vocab.bag_of_words(docs, words, clean=True).collect()}
    assert clean == {(1, "neg", 0, 3), (1, "pos", 3, 3), (2, "pos", 1, 1)}
    pairs = {r.Id: (r.pos, r.neg, r.label) for r in prep.pair_views(vocab.bag_of_words(docs, words), docs).collect()}
    assert pairs[3] == ([], [], None)
    assert [(h.idx, h.cnt) for h in pairs[1][1]] == [(0, 2)] and pairs[1][2] == 0


@pytest.mark.parametrize("top_n", [0, 1, 2, 3, 5, 99])
def test_only_words_at_the_cut_or_above_are_ordered(spark, top_n):
    text = "a a a b b c c d e"
    df = spark.createDataFrame([(text,)], "t string")
    counts = df.select(F.explode(F.split("t", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    assert vocab.frequency_cut(counts, top_n) == {0: 3, 1: 3, 2: 2, 3: 2, 5: 1, 99: 0}[top_n]
    found = vocab.corpus_vocab(df, "t", top_n).where("token > 2").orderBy("token").collect()
    assert [(r.word, r.freq) for r in found] == [("a", 3), ("b", 2), ("c", 2), ("d", 1), ("e", 1)][:top_n]


def test_corpus_vocab_keeps_reserved_words_unique(spark):
    df = spark.createDataFrame([("a b a </s>",), (None,)], "t string")
    words = {r.word: r.token for r in vocab.corpus_vocab(df, "t", 2).collect()}
    assert words == {"<pad>": 0, "</s>": 1, "<unk>": 2, "a": 3, "": 4}


@pytest.mark.parametrize("direct", [True, False])
def test_linear_scores_equal_a_direct_sum(spark, direct):
    rows = [(1, 0, "x x y"), (2, 1, "y z z"), (3, 1, "z"), (4, 0, "q")]
    df = reviews(spark, rows)
    freqs = vocab.class_word_freq(df)
    words = vocab.build_vocab(df, threshold=1)
    weights = classify.word_weights(classify.class_counts(freqs, words))
    if direct:
        scores = classify.text_scores(df, weights, classify.class_priors(df))
    else:
        scores = classify.linear_scores(vocab.bag_of_words(df, words), df, weights, classify.class_priors(df))
    got = {(r.Id, r.view): (r.s0, r.s1) for r in scores.collect()}
    assert len(got) == 8
    # neg vocabulary: x (2 in neg, 0 in pos); pos vocabulary: z (0 in neg, 3 in pos).
    half = math.log(0.5)
    assert got[(1, "neg")] == pytest.approx((half + 2 * math.log(3 / 3), half + 2 * math.log(1 / 1)))
    assert got[(4, "pos")] == pytest.approx((half, half))
    fused = {r.Id: r for r in classify.predict_labels(classify.fuse(scores)).collect()}
    assert fused[4].pred == 0, "equal scores give the lowest class"
    both = {r.Id: (r.s0, r.s1) for r in classify.fuse(scores, "probability").collect()}
    assert all(sum(p) == pytest.approx(1) for p in both.values())


def test_improving_epochs(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.6), (4, 0.55), (5, 0.6)], "epoch int, accuracy double")
    assert [r.epoch for r in classify.improving_epochs(df).orderBy("epoch").collect()] == [1, 3]
    assert classify.improving_epochs(df.withColumn("accuracy", F.lit(0.0))).isEmpty()


def test_running_mean(spark):
    df = spark.createDataFrame([(1, 0, 4.0), (1, 1, 2.0), (1, 2, 3.0), (2, 0, 1.0)], "epoch int, batch int, loss double")
    got = {(r.epoch, r.batch): r.running_loss for r in classify.running_mean_loss(df).collect()}
    assert got == {(1, 0): 4.0, (1, 1): 3.0, (1, 2): 3.0, (2, 0): 1.0}


def test_accuracy_and_misclassified(spark):
    labels = spark.createDataFrame([(1, 0, "a", "dev"), (2, 1, "b", "dev"), (3, None, "c", "test")], REVIEWS + ", split string")
    pred = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "Id bigint, pred int")
    assert [tuple(r) for r in classify.accuracy(pred, labels).collect()] == [("dev", 2, 1, 0.5)]
    assert [tuple(r) for r in classify.misclassified(pred, labels).collect()] == [(2, "b", 1, 0)]


def toy(spark):
    rows = [(i, i % 2, " ".join((["bad", "poor"] if i % 2 == 0 else ["good", "fine"]) * 3 + ["the"])) for i in range(40)]
    return reviews(spark, rows)


@pytest.mark.parametrize("kind", ["logistic", "perceptron"])
def test_two_view_models_learn_and_survive_a_round_trip(spark, tmp_path, kind):
    df = toy(spark)
    words = vocab.build_vocab(df)
    model = models.fit_two_views(df, words, kind, hidden=(4,), max_iter=30)
    scored = models.model_scores(model, df)
    assert scored.where("pred <> Category").isEmpty()
    save_model(model, words, str(tmp_path / "m"))
    again, stored = load_model(spark, str(tmp_path / "m"))
    assert stored.count() == words.count()
    ours = {r.Id: (r.pred, tuple(r.scores)) for r in scored.collect()}
    assert ours == {r.Id: (r.pred, tuple(r.scores)) for r in models.model_scores(again, df).collect()}


def test_vectors_equal_a_vectorizer_over_the_listed_words(spark):
    df = reviews(spark, [(1, 0, "a b a"), (1, 1, "c"), (2, 0, "z"), (3, 1, None), (4, 0, ""), (5, 1, "c a " * 500)])
    words = spark.createDataFrame([("neg", "a", 0, 9), ("neg", "c", 1, 9), ("pos", "b", 0, 9), ("pos", "a", 1, 9), ("pos", "nan", 2, 9)], "cls string, word string, idx bigint, freq bigint")
    split = df.withColumn("words", split_words(text_or_token(F.col("text"))))
    for view, listed in (("neg", ["a", "c"]), ("pos", ["b", "a", "nan"])):
        counter = CountVectorizerModel.from_vocabulary(listed, inputCol="words", outputCol="v")
        want = sorted((r.Id, str(r.v)) for r in counter.transform(split).collect())
        assert sorted((r.Id, str(r[f"{view}_features"])) for r in models.add_vectors(df, words).collect()) == want
    with pytest.raises(ValueError, match="pos.*empty"):
        models.add_vectors(df, words.where("cls = 'neg'"))


def test_a_vocabulary_of_two_million_words(spark):
    n = 1 << 21
    words = spark.range(2 * n).select(F.when(F.col("id") < n, "neg").otherwise("pos").alias("cls"), F.concat(F.lit("w"), F.col("id") % n).alias("word"), (F.col("id") % n).alias("idx"), F.lit(11).alias("freq"))
    words = materialize(words, "words")
    df = reviews(spark, [(i, i % 2, f"w{n - 1 - i % 2} w{i} w7") for i in range(20)])
    model = models.fit_two_views(df, words, max_iter=3)
    assert {c.numFeatures for c in model.classifiers.values()} == {n}
    assert models.model_scores(model, df).where("pred <> Category").isEmpty()


def test_a_model_fitted_after_a_write_can_be_applied(spark):
    materialize(spark.range(3), "three")
    df = toy(spark)
    assert models.model_scores(models.fit_two_views(df, vocab.build_vocab(df), max_iter=2), df).count() == 40


def test_prediction_needs_a_complete_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))
    df = toy(spark)
    words = vocab.build_vocab(df)
    save_model(models.fit_two_views(df, words, max_iter=2), words, str(tmp_path / "m"))
    shutil.rmtree(tmp_path / "m" / "neg")
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "m"))


def test_train_and_predict_jobs(spark, tmp_path):
    df = toy(spark)
    report = classification.train(spark, df, df.where("Id < 10"), str(tmp_path / "m"))
    assert {r.split: (r.n, r.accuracy) for r in report.collect()} == {"train": (40, 1.0), "dev": (10, 1.0)}
    pred = classification.predict(spark, str(tmp_path / "m"), df.drop("Category"))
    assert {r.Id: r.pred for r in pred.collect()} == {i: i % 2 for i in range(40)}
    linear = classification.linear_predictions(df, df)
    assert {r.Id: r.pred for r in linear.collect()} == {i: i % 2 for i in range(40)}


def test_pair_views_keep_rows_of_one_id_and_rows_without_an_id(spark):
    reviews = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (None, None), (2, None)], "Id bigint, Category int")
    bag = spark.createDataFrame([(1, "pos", 3, 2), (1, "neg", 1, 1), (1, "pos", 0, 1), (None, "pos", 4, 1), (9, "pos", 1, 1)], "Id bigint, cls string, idx bigint, cnt bigint")
    got = sorted(((r.Id, r.pos, r.neg, r.label) for r in prep.pair_views(bag, reviews).collect()), key=str)
    held = [(0, 1), (3, 2)], [(1, 1)]
    assert got == sorted([(1, *held, 0), (1, *held, 1), (None, [], [], 1), (None, [], [], None), (2, [], [], None)], key=str)


def test_a_perceptron_scores_as_its_spark_model_and_never_holds_a_number_per_word(spark, monkeypatch):
    df = toy(spark)
    words = vocab.build_vocab(df)
    model = models.fit_two_views(df, words, "perceptron", hidden=(5, 3), max_iter=4)
    dense = models.add_vectors(df, words)
    for classifier in model.classifiers.values():
        assert not classifier._java_obj.isSet(classifier._java_obj.initialWeights())
        dense = classifier.transform(dense)
    want = {r.Id: [(a + b) / 2 for a, b in zip(r.neg_raw, r.pos_raw)] for r in dense.collect()}
    for r in models.model_scores(model, df).collect():
        assert r.scores == pytest.approx(want[r.Id], abs=1e-9)
    for r in models.model_scores(model, df, "probability").collect():
        assert sum(r.scores) == pytest.approx(1)


def test_a_perceptron_of_a_large_vocabulary(spark):
    # With a number per word and row, 3,000 rows of both views would hold 6 GB.
    n = 1 << 17
    words = spark.range(2 * n).select(F.when(F.col("id") < n, "neg").otherwise("pos").alias("cls"), F.concat(F.lit("w"), F.col("id") % n).alias("word"), (F.col("id") % n).alias("idx"), F.lit(11).alias("freq"))
    words = materialize(words, "words")
    df = reviews(spark, [(i, i % 2, f"w{n - 1 - i % 2} w{i} w7" if i != 5 else "") for i in range(3000)])
    model = models.fit_two_views(df, words, "perceptron", hidden=(2,), max_iter=20)
    assert models.model_scores(model, df).where("Id <> 5 and pred <> Category").isEmpty()


def test_vector_totals_do_not_grow_with_the_vocabulary(spark, monkeypatch):
    from checks import registry

    last = (1 << 31) - 2
    words = materialize(spark.createDataFrame([("neg", "a", 0, 11), ("neg", "b", last, 11), ("pos", "c", 4, 11)], "cls string, word string, idx bigint, freq bigint"), "words")
    monkeypatch.setattr(registry.views, "reviews", lambda spark, folder: reviews(spark, [(1, 0, "a b a"), (2, 1, "c c"), (3, 1, None)]))
    monkeypatch.setattr(registry, "_vocab", lambda reviews: words)
    got = {tuple(r) for r in registry.a4_vector_totals(spark, "").collect()}
    assert got == {(1, last + 3, 0), (2, 0, 10), (3, 0, 0)}


def _plan(df):
    """The plan as it ran, once ``df`` was collected."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_texts_move_once_and_their_words_are_counted_in_place(spark):
    words = materialize(spark.createDataFrame([("neg", "a", 0, 11), ("pos", "b", 1, 12)], "cls string, word string, idx bigint, freq bigint"), "words")
    docs = materialize(reviews(spark, [(1, 0, "a b a"), (1, 1, "a"), (None, 1, "b b"), (None, 0, "b a"), (2, 1, "z")]), "docs")
    bag = vocab.bag_of_words(docs, words)
    assert {tuple(r) for r in bag.collect()} == {(1, "neg", 0, 3), (1, "pos", 1, 1), (None, "pos", 1, 3), (None, "neg", 0, 1)}
    held = vocab.bag_of_words(docs.where("Id is not null"), words)
    assert held.count() == 2 and held.collect()
    assert _plan(held).index("Generate") < _plan(held).index("Exchange hashpartitioning")


def test_hits_in_order_of_ids_are_paired_where_they_are(spark):
    words = materialize(spark.createDataFrame([("neg", "a", 0, 11), ("pos", "b", 1, 12)], "cls string, word string, idx bigint, freq bigint"), "words")
    docs = materialize(reviews(spark, [(1, 0, "a b a"), (None, 1, "b b"), (2, 1, "z")]), "docs")
    pairs = prep.pair_views(vocab.bag_of_words(docs, words), docs)
    assert {(r.Id, len(r.pos), len(r.neg), r.label) for r in pairs.collect()} == {(1, 1, 1, 0), (None, 0, 0, 1), (2, 0, 0, 1)}
    plan = _plan(pairs)
    # One of the texts and one of the labels.
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_fit_reads_its_rows_in_as_many_tasks_as_cores(spark, monkeypatch):
    seen, whole, fit = [], models.add_vectors, models.LogisticRegression.fit

    def noted(self, data):
        seen.append(data.rdd.getNumPartitions())
        return fit(self, data)

    monkeypatch.setattr(models, "add_vectors", lambda *a: whole(*a).repartition(40))
    monkeypatch.setattr(models.LogisticRegression, "fit", noted)
    df = toy(spark)
    models.fit_two_views(df, vocab.build_vocab(df), max_iter=1)
    assert len(seen) == 2 and max(seen) <= spark.sparkContext.defaultParallelism


def test_vectors_of_a_small_vocabulary_move_no_words(spark, monkeypatch):
    words = materialize(spark.createDataFrame([("neg", "a", 1, 11), ("neg", "", 0, 11), ("pos", "a", 2, 11), ("pos", "nan", 0, 11)], "cls string, word string, idx bigint, freq bigint"), "words")
    df = reviews(spark, [(1, 0, "a b  a"), (1, 1, "x"), (2, 1, None), (None, 1, "a"), (4, 0, "")]).repartition(2)
    listed = lambda: sorted(str(tuple(r)) for r in models.add_vectors(df, words).collect())
    with monkeypatch.context() as m:
        m.setattr(models, "list_lookup", lambda *a: None)
        joined = listed()
    # A join of the words, or rows written to be joined, would fail here.
    monkeypatch.setattr(models, "lookup_join", None)
    monkeypatch.setattr(models, "materialize", None)
    assert listed() == joined and len(joined) == 5
    assert models.add_vectors(df, words, ["Id"]).columns == ["Id", "neg_features", "pos_features"]


def test_counts_of_many_positions(spark):
    # Parts of a million positions, and a text that is longer than one.
    df = spark.createDataFrame([(n,) for n in (3, 700_000, 0, 600_000, 1_200_000, 5)], "n int").coalesce(1)
    lists = df.select("n", F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), "n"), lambda i: F.when(i % 3 > 0, i % 3))).otherwise(F.array().cast("array<int>")).alias("at"))
    got = {r.n: (r.v.size, r.v.indices, r.v["values"]) for r in lists.select("n", models._counted(4)("at").alias("v")).collect()}
    assert got == {n: (4, [i for i in (1, 2) if n], [float(len(range(i, n + 1, 3))) for i in (1, 2) if n]) for n in (3, 700_000, 0, 600_000, 1_200_000, 5)}


def test_a_perceptron_is_trained_with_pieces_of_its_vectors_on_the_driver(spark, monkeypatch):
    import tracemalloc

    monkeypatch.setattr(models, "PIECE", 1 << 15, raising=False)
    monkeypatch.setattr(models, "READ", 1 << 13, raising=False)
    n, hidden = 1 << 16, 16
    words = spark.range(2 * n).select(F.when(F.col("id") < n, "neg").otherwise("pos").alias("cls"), F.concat(F.lit("w"), F.col("id") % n).alias("word"), (F.col("id") % n).alias("idx"), F.lit(11).alias("freq"))
    words = materialize(words, "words")
    df = reviews(spark, [(i, i % 2, f"w{n - 1 - i % 2} w{i} w7") for i in range(300)])
    whole = models._trained
    peaks = []

    def watched(*a):
        tracemalloc.start()
        try:
            return whole(*a)
        finally:
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()

    monkeypatch.setattr(models, "_trained", watched)
    model = models.fit_two_views(df, words, "perceptron", hidden=(hidden,), max_iter=7)
    # Less than the weights alone.
    assert max(peaks) < n * hidden * 8
    assert models.model_scores(model, df).where("pred <> Category").isEmpty()
