"""The queries, one or more per operator. Each reads whole tables of ``folder``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import views
from lexmill.functions import cleaning
from lexmill.functions.hashing import unit_hash
from lexmill.operators import candidates as cand
from lexmill.operators import classify, encode, evaluate, models, prep, titles, vocab
from lexmill.plans import classification, titling
from lexmill.runtime import materialize, scratch_path
from lexmill.sources import files, stores
from lexmill.sources.models import load_model, save_model

TOP_N = 32_000
STEPS = 64
TITLE_MODES = ("greedy", "beam", "sample", "topk", "topp", "synthesis")
ALPHAS = [4096.0, 256.0, 64.0, 16.0, 1.0, 0.25]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(column: str | Column, name: str | None = None) -> Column:
    """Rounded to six places, for comparison."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(name or column)


def _text(column: str) -> Column:
    """An array as text, for comparison."""
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def _train(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


def _vocab(reviews: DataFrame) -> DataFrame:
    return vocab.build_vocab(_train(reviews))


def _clean_news(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_articles(views.news_like(spark, folder))


def _news_vocab(news: DataFrame) -> DataFrame:
    return vocab.corpus_vocab(news, F.concat_ws(" ", "title", "maintext"), TOP_N)


def _scored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The reviews and their scores by counted weights."""
    reviews = views.reviews(spark, folder)
    freqs = materialize(vocab.class_word_freq(_train(reviews)), "class-word-freq")
    words = materialize(vocab.vocab_index(vocab.frequent_words(freqs)), "vocab")
    weights = classify.word_weights(classify.class_counts(freqs, words))
    return reviews, classify.text_scores(reviews, weights, classify.class_priors(_train(reviews)))


def _title_model(spark: SparkSession, folder: str) -> tuple[DataFrame, titling.TitleModel]:
    articles = views.articles(spark, folder)
    return articles, titling.train(articles, TOP_N)


def _lead_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The first sentence of each article against its title."""
    lead = F.trim(F.get(F.split(F.trim(F.col("maintext")), "[.!?。！？]", 2), 0))
    return views.articles(spark, folder).select("id", evaluate.or_placeholder(lead).alias("pred"), F.col("title").alias("ref"))


def _dialog(spark: SparkSession, folder: str) -> DataFrame:
    key = F.concat_ws("-", "conv_id", "turn")
    return views.dialog_pairs(spark, folder).select(key.alias("id"), F.col("source_text").alias("pred"), F.col("target_text").alias("ref"))


# -- sources and sinks --------------------------------------------------------------------------------


@query
def s1_csv_round_trip(spark, folder):
    path = scratch_path(spark, "reviews-csv")
    files.write_reviews(views.reviews(spark, folder), path)
    return files.read_reviews(spark, path)


@query
def s2_jsonl_round_trip(spark, folder):
    path = scratch_path(spark, "articles-jsonl")
    files.write_articles(views.articles(spark, folder), path)
    return files.read_articles(spark, path)


@query
def s3_answer_csv(spark, folder):
    path = scratch_path(spark, "answers")
    reviews, scores = _scored(spark, folder)
    test = reviews.where(F.col("split") == "test").select("Id")
    files.write_answers(classify.predict_labels(classify.fuse(scores)).join(test, "Id"), path)
    return files.read_answers(spark, path)


@query
def s4_title_jsonl(spark, folder):
    path = scratch_path(spark, "titles")
    files.write_titles(_lead_pairs(spark, folder).select("id", F.col("pred").alias("title")), path)
    return files.read_titles(spark, path)


@query
def s5_bag_store(spark, folder):
    root = scratch_path(spark, "bag-store")
    reviews = views.reviews(spark, folder)
    words = _vocab(reviews)

    def build(rows):
        return vocab.bag_of_words(rows, words).join(rows.select("Id", "split"), "Id")

    before = reviews.withColumn("text", F.when(F.crc32(F.col("Id").cast("string").cast("binary")) % 97 == 0, F.lit("as it was")).otherwise(F.col("text")))
    for state in (before, reviews):
        bag = stores.bag_store(spark, root, words, state, build)
    return bag.select("Id", "cls", "idx", "cnt", "split")


@query
def s6_feature_store(spark, folder):
    root = scratch_path(spark, "feature-store")
    news = views.news_like(spark, folder)
    words = _news_vocab(_clean_news(spark, folder))
    made_from = f"{stores.vocab_key(words)}/{encode.TITLE_LENGTH}"
    ones = F.array_size(F.array_remove("attention_mask", 0)).cast("bigint")
    parts = []
    for mode, length in (("train", encode.TEXT_LENGTH), ("train", 128), ("eval", encode.TEXT_LENGTH)):

        def build(rows, mode=mode, length=length):
            return encode.build_features(rows, words, mode, length, encode.TITLE_LENGTH, keep_id=True)

        for _ in range(2):
            part = stores.article_features(root, news, mode, "words 1.0", length, build, made_from)
        labels = _text("labels") if mode == "train" else F.lit(None).cast("string").alias("labels")
        key = [F.lit(mode).alias("mode"), F.lit(length).alias("max_len"), F.col("id").cast("bigint").alias("id")]
        parts.append(part.select(*key, ones.alias("n_tokens"), _text("input_ids"), labels))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def s7_model_round_trip(spark, folder):
    root = scratch_path(spark, "model")
    reviews = views.reviews(spark, folder)
    words = _vocab(reviews)
    fitted = models.fit_two_views(_train(reviews), words)
    save_model(fitted, words, root)
    model, _ = load_model(spark, root)
    before, after = (models.model_scores(m, reviews.select("Id", "text")).select("Id", F.col("scores").alias(n), F.col("pred").alias(f"p{n}")) for m, n in ((fitted, "a"), (model, "b")))
    return before.join(after, "Id").select("Id", ((F.col("a") == F.col("b")) & (F.col("pa") == F.col("pb"))).alias("same"))


@query
def s8_metric_log(spark, folder):
    root = scratch_path(spark, "metric-log")
    losses = _batch_losses(spark, folder, epochs=2)
    for epoch in (1, 2):
        stores.append_metrics(losses.where(F.col("epoch") == epoch), root, ["epoch", "view", "batch"], ["loss", "n"])
    return stores.read_metrics(spark, root).select("epoch", "view", "batch", "metric", _r("value"))


# -- splits, samples, projections, alignment ----------------------------------------------------------


@query
def p1_union_splits(spark, folder):
    reviews = views.reviews(spark, folder)
    part = {s: reviews.where(F.col("split") == s).drop("split") for s in ("train", "dev", "test")}
    part["test"] = part["test"].drop("Category")
    return prep.union_splits(**part).select("Id", "Category", "split")


@query
def p2_class_partition(spark, folder):
    reviews = views.reviews(spark, folder)
    return reviews.select("Id", prep.class_of(F.col("Category")).alias("cls"))


@query
def p3_scoring_sample(spark, folder):
    return prep.hash_sample(views.articles(spark, folder), "id").select("id", "title")


@query
def p4_eval_columns(spark, folder):
    news = views.news_like(spark, folder)
    features = encode.build_features(news, _news_vocab(_clean_news(spark, folder)), "eval")
    return prep.mode_columns(features, "eval").select(_text("input_ids"), _text("attention_mask"), "id")


@query
def p5_null_text(spark, folder):
    documents = views.documents(spark, folder, "text")
    text = F.when(unit_hash(8, "doc_id") >= 0.2, F.col("text"))
    words = cleaning.split_words(cleaning.text_or_token(text))
    nans = F.size(F.filter(words, lambda w: w == "nan"))
    return documents.select("doc_id", F.size(words).alias("n_words"), nans.alias("n_nan"))


@query
def p6_numeric_id(spark, folder):
    return prep.numeric_id(views.articles(spark, folder)).select("id", "title")


@query
def p7_pair_views(spark, folder):
    reviews = views.reviews(spark, folder)
    pairs = prep.pair_views(vocab.bag_of_words(reviews, _vocab(reviews)), reviews)

    def listed(view: str) -> Column:
        items = F.transform(view, lambda h: F.concat_ws(":", h.idx.cast("string"), h.cnt.cast("string")))
        return F.array_join(items, " ").alias(view)

    return pairs.select("Id", "label", listed("pos"), listed("neg"))


@query
def p8_batches(spark, folder):
    return prep.assign_batches(views.reviews(spark, folder).select("split", "Id"), 64, "Id", ("split",))


@query
def p8_batches_shuffled(spark, folder):
    reviews = views.reviews(spark, folder)
    return prep.assign_batches(reviews.select("split", "Id"), 64, "Id", ("split",), shuffle_seed=3)


@query
def p9_split_sizes(spark, folder):
    return prep.split_sizes(views.reviews(spark, folder))


# -- cleaning -----------------------------------------------------------------------------------------


@query
def t1_strip_marks(spark, folder):
    return views.reviews_marked(spark, folder).select("Id", cleaning.strip_review_marks(F.col("text")).alias("text"))


@query
def t2_collapse_spaces(spark, folder):
    return views.reviews_marked(spark, folder).select("Id", cleaning.collapse_spaces(F.col("text")).alias("text"))


@query
def t3_split_words(spark, folder):
    words = cleaning.split_words(F.concat("text", F.lit("  end ")))
    return views.reviews(spark, folder).select("Id", F.posexplode(words).alias("pos", "word"))


@query
def t4_clean_articles(spark, folder):
    return _clean_news(spark, folder).select("id", "maintext")


# -- vocabulary and bag of words ----------------------------------------------------------------------


@query
def a1_class_word_freq(spark, folder):
    return vocab.class_word_freq(_train(views.reviews_marked(spark, folder)))


@query
def a2_frequent_words(spark, folder):
    return vocab.frequent_words(vocab.class_word_freq(_train(views.reviews_marked(spark, folder))))


@query
def a3_vocab_index(spark, folder):
    return vocab.build_vocab(_train(views.reviews_marked(spark, folder)))


@query
def a4_bag_of_words(spark, folder):
    reviews = views.reviews_marked(spark, folder)
    return vocab.bag_of_words(reviews, _vocab(reviews))


@query
def a4_bag_of_clean_words(spark, folder):
    reviews = views.reviews_marked(spark, folder)
    return vocab.bag_of_words(reviews, _vocab(reviews), clean=True)


@query
def a4_vector_totals(spark, folder):
    reviews = views.reviews(spark, folder)
    words = _vocab(reviews)
    vectors = models.add_vectors(reviews, words)

    # A word that a text lacks adds nothing, so a row costs as much as it has words, whatever the size of the vocabulary.
    @F.udf("bigint")
    def total(v):
        return int(((v.indices.astype("int64") + 1) * v.values.astype("int64")).sum())

    return vectors.select("Id", *[total(f"{v}_features").alias(f"{v}_total") for v in classify.VIEWS])


@query
def a5_vocab_sizes(spark, folder):
    return vocab.vocab_sizes(_vocab(views.reviews(spark, folder)))


# -- classification -----------------------------------------------------------------------------------


def _fit_per_split(model: models.TwoViewModel, reviews: DataFrame) -> DataFrame:
    """What must hold for any fit: scores are finite, the label is that of the larger one, most training labels are right."""
    a, b = F.get("scores", 0), F.get("scores", 1)
    finite = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    right = F.avg((F.col("pred") == F.col("Category")).cast("int")) > 0.5
    return models.model_scores(model, reviews).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(finite).alias("n_finite"), F.count_if(F.col("pred") == (b > a).cast("int")).alias("n_of_larger"), F.coalesce(right, F.lit(True)).alias("learned")
    )


@query
def c1_two_view_logistic(spark, folder):
    reviews = views.reviews(spark, folder)
    return _fit_per_split(models.fit_two_views(_train(reviews), _vocab(reviews), "logistic"), reviews)


@query
def c1_two_view_perceptron(spark, folder):
    reviews = views.reviews(spark, folder)
    return _fit_per_split(models.fit_two_views(_train(reviews), _vocab(reviews), "perceptron"), reviews)


@query
def c2_linear_scores(spark, folder):
    _, scores = _scored(spark, folder)
    return scores.select("Id", "view", _r("s0"), _r("s1"))


@query
def c2_linear_scores_of_bag(spark, folder):
    reviews = views.reviews(spark, folder)
    freqs = materialize(vocab.class_word_freq(_train(reviews)), "class-word-freq")
    words = materialize(vocab.vocab_index(vocab.frequent_words(freqs)), "vocab")
    weights = classify.word_weights(classify.class_counts(freqs, words))
    scores = classify.linear_scores(vocab.bag_of_words(reviews, words), reviews, weights, classify.class_priors(_train(reviews)))
    return scores.select("Id", "view", _r("s0"), _r("s1"))


@query
def c3_fused_scores(spark, folder):
    _, scores = _scored(spark, folder)
    return classify.fuse(scores).select("Id", _r("s0"), _r("s1"))


@query
def c3_fused_probabilities(spark, folder):
    _, scores = _scored(spark, folder)
    return classify.fuse(scores, "probability").select("Id", _r("s0"), _r("s1"))


@query
def c4_argmax_label(spark, folder):
    _, scores = _scored(spark, folder)
    return classify.predict_labels(classify.fuse(scores)).select("Id", "pred")


@query
def c5_accuracy(spark, folder):
    reviews, scores = _scored(spark, folder)
    scored = classify.accuracy(classify.predict_labels(classify.fuse(scores)), reviews)
    return scored.select("split", "n", "n_right", _r("accuracy"))


def _batch_losses(spark: SparkSession, folder: str, epochs: int) -> DataFrame:
    """(epoch, view, batch, loss, n): the training texts shuffled anew in each epoch and view, in batches of 64."""
    reviews, scores = _scored(spark, folder)
    losses = materialize(classify.cross_entropy(scores, _train(reviews)), "losses")
    repeated = losses.select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "view", "Id", "loss")
    batches = prep.assign_batches(repeated, 64, "Id", ("epoch", "view"), shuffle_seed=1)
    return batches.groupBy("epoch", "view", "batch").agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n"))


@query
def c6_running_loss(spark, folder):
    running = classify.running_mean_loss(_batch_losses(spark, folder, epochs=3), ("epoch", "view"))
    return running.select("epoch", "view", "batch", _r("running_loss"))


@query
def c7_best_epochs(spark, folder):
    reviews = views.reviews(spark, folder)
    _, kept, _ = classification.choose_epoch(_train(reviews), reviews.where(F.col("split") == "dev"), ALPHAS)
    return kept.select("epoch", _r("accuracy"), _r("best_before"))


@query
def c7_best_epoch_answers(spark, folder):
    reviews = views.reviews(spark, folder)
    dev, test = (reviews.where(F.col("split") == s) for s in ("dev", "test"))
    return classification.best_predictions(_train(reviews), dev, test, ALPHAS).select("Id", "pred")


@query
def c8_linear_predict(spark, folder):
    reviews = views.reviews(spark, folder)
    test = reviews.where(F.col("split") == "test")
    return classification.linear_predictions(_train(reviews), test).select("Id", "pred")


@query
def c8_model_predict(spark, folder):
    root = scratch_path(spark, "model")
    reviews = views.reviews(spark, folder)
    dev, test = (reviews.where(F.col("split") == s) for s in ("dev", "test"))
    report = materialize(classification.train(spark, _train(reviews).drop("split"), dev.drop("split"), root), "report")
    if report.count() != 2:
        raise AssertionError("the job reports the accuracy of both splits")
    stored = classification.predict(spark, root, test)
    fitted = models.model_scores(load_model(spark, root)[0], test.select("Id", "text")).select("Id", F.col("pred").alias("fitted"))
    return stored.join(fitted, "Id").select("Id", (F.col("pred") == F.col("fitted")).alias("same"))


@query
def c9_misclassified(spark, folder):
    reviews, scores = _scored(spark, folder)
    return classify.misclassified(classify.predict_labels(classify.fuse(scores)), reviews)


# -- encoded features ---------------------------------------------------------------------------------


@query
def e0_corpus_vocab(spark, folder):
    return _news_vocab(_clean_news(spark, folder))


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    news = _clean_news(spark, folder)
    columns = {"input_ids": ("maintext", encode.TEXT_LENGTH), "title_ids": ("title", encode.TITLE_LENGTH)}
    return encode.encode(news, _news_vocab(news), "id", columns)


@query
def e1_encode(spark, folder):
    encoded = _encoded(spark, folder).withColumn("attention_mask", encode.token_mask(F.col("input_ids")))
    return encoded.select("id", _text("input_ids"), _text("attention_mask"), _text("title_ids"))


@query
def e2_decoder_start(spark, folder):
    shifted = encode.decoder_start(F.col("title_ids"), encode.TITLE_LENGTH)
    return _encoded(spark, folder).select("id", shifted.alias("ids")).select("id", _text("ids"))


@query
def e3_teacher_forcing(spark, folder):
    forced = encode.teacher_forcing(_encoded(spark, folder), "title_ids", encode.TITLE_LENGTH)
    return forced.select("id", _text("decoder_input_ids"), _text("decoder_attention_mask"), _text("labels"))


@query
def e4_decode(spark, folder):
    news = _clean_news(spark, folder)
    words = _news_vocab(news)
    encoded = encode.encode(news, words, "id", {"ids": ("title", encode.TITLE_LENGTH)})
    return encode.decode(encoded, words, "id", "ids")


@query
def e5_train_features(spark, folder):
    features = encode.build_features(views.news_like(spark, folder), _news_vocab(_clean_news(spark, folder)), "train", keep_id=True)
    return features.select("id", *[_text(c) for c in prep.TRAIN_COLUMNS])


@query
def e6_mapped_features(spark, folder):
    def lengths(batch):
        return batch.assign(n_words=batch["text"].str.split(" ").str.len(), n_lines=batch["text"].str.count("\n") + 1)[
            ["doc_id", "n_words", "n_lines"]
        ]

    documents = views.documents(spark, folder, "text")
    return encode.map_features(documents, lengths, "doc_id bigint, n_words bigint, n_lines bigint")


# -- candidates and titles ----------------------------------------------------------------------------


@query
def g0_bigram_table(spark, folder):
    _, model = _title_model(spark, folder)
    return model.bigrams.select("prev", "next", "cnt", "prev_cnt", _r("logp"))


def _candidates(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    _, model = _title_model(spark, folder)
    return cand.candidates(model.bigrams, "prev", "next", mode).select("prev", "next", _r("p"))


@query
def g1_softmax(spark, folder):
    _, model = _title_model(spark, folder)
    return cand.softmax(model.bigrams, "prev", temperature=cand.TEMPERATURE).select("prev", "next", _r("p"))


@query
def g2_top_k(spark, folder):
    return _candidates(spark, folder, "topk")


@query
def g3_top_p(spark, folder):
    return _candidates(spark, folder, "topp")


@query
def g4_synthesis(spark, folder):
    return _candidates(spark, folder, "synthesis")


@query
def g5_weighted_draw(spark, folder):
    _, model = _title_model(spark, folder)
    scored = cand.candidates(model.bigrams, "prev", "next", "sample")
    return cand.draw(scored, "prev", "next", seed=5).select("prev", "next")


def _titles(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    articles, model = _title_model(spark, folder)
    return titling.titles(model, articles, mode, max_len=STEPS)


@query
def g5_sample_titles(spark, folder):
    return _titles(spark, folder, "sample")


@query
def g5_topk_titles(spark, folder):
    return _titles(spark, folder, "topk")


@query
def g5_topp_titles(spark, folder):
    return _titles(spark, folder, "topp")


@query
def g5_synthesis_titles(spark, folder):
    return _titles(spark, folder, "synthesis")


@query
def g6_greedy_titles(spark, folder):
    return _titles(spark, folder, "greedy")


@query
def g7_beam_titles(spark, folder):
    articles, model = _title_model(spark, folder)
    return titling.titles(model, articles, "beam", max_len=STEPS, no_repeat=False)


@query
def g8_beam_titles_no_repeat(spark, folder):
    return _titles(spark, folder, "beam")


@query
def g9_batch_inference(spark, folder):
    return titles.generate(views.articles(spark, folder), titles.first_sentence_loader())


# -- evaluation ---------------------------------------------------------------------------------------


def _rouge(scored: DataFrame, hits: str) -> DataFrame:
    return scored.select("id", hits, F.col("n_pred").cast("bigint").alias("n_pred"), F.col("n_ref").cast("bigint").alias("n_ref"), _r("f"))


@query
def o1_rouge_1(spark, folder):
    return _rouge(evaluate.rouge_n(_lead_pairs(spark, folder), 1), "overlap")


@query
def o1_rouge_2(spark, folder):
    return _rouge(evaluate.rouge_n(_lead_pairs(spark, folder), 2), "overlap")


@query
def o1_rouge_2_chars(spark, folder):
    return _rouge(evaluate.rouge_n(_lead_pairs(spark, folder), 2, "char"), "overlap")


@query
def o1_rouge_1_dialog(spark, folder):
    return _rouge(evaluate.rouge_n(_dialog(spark, folder), 1), "overlap")


@query
def o1l_rouge_l(spark, folder):
    return _rouge(evaluate.rouge_l(_lead_pairs(spark, folder)), "lcs")


@query
def o1l_rouge_l_dialog(spark, folder):
    return _rouge(evaluate.rouge_l(_dialog(spark, folder)), "lcs")


@query
def o2_placeholder(spark, folder):
    rest = F.trim(F.regexp_replace("text", "(?s)^[^.]*[.]", ""))
    return views.documents(spark, folder, "text").select("doc_id", evaluate.or_placeholder(rest).alias("title"))


@query
def o3_batch_means(spark, folder):
    articles, model = _title_model(spark, folder)
    nll = evaluate.token_nll(titling.features(model, articles), model.bigrams, TOP_N + 3)
    losses = materialize(nll.select(F.col("id").cast("bigint").alias("id"), F.col("nll").alias("v_loss")), "losses")
    sample = materialize(prep.hash_sample(_lead_pairs(spark, folder), "id"), "sample")
    scores = [evaluate.rouge_n(sample, 1), evaluate.rouge_n(sample, 2), evaluate.rouge_l(sample)]
    names = ["rouge_1", "rouge_2", "rouge_l"]
    one, two, three = (s.select("id", F.col("f").alias(n)) for s, n in zip(scores, names, strict=True))
    scored = materialize(one.join(two, "id").join(three, "id").withColumn("id", F.col("id").cast("bigint")), "scored")
    rows = [
        evaluate.batch_mean(losses, ["v_loss"], weighting=w).crossJoin(F.broadcast(evaluate.batch_mean(scored, names, weighting=w))).select(F.lit(w).alias("weighting"), *[_r(c) for c in ("v_loss", *names)])
        for w in ("batch", "row")
    ]
    return rows[0].unionByName(rows[1])


def _nll_columns(scored: DataFrame, key: str = "id") -> DataFrame:
    return scored.select(key, "n_tokens", _r("nll"), _r(F.log("perplexity"), "log_perplexity"))


@query
def o4_token_nll(spark, folder):
    articles, model = _title_model(spark, folder)
    return _nll_columns(evaluate.token_nll(titling.features(model, articles), model.bigrams, TOP_N + 3))


@query
def o4_benchmark_nll(spark, folder):
    _, model = _title_model(spark, folder)
    items = views.table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    return _nll_columns(evaluate.text_nll(items, "text", model.vocab, model.bigrams, TOP_N + 3))


def _greedy_and_drawn(articles: DataFrame, model: titling.TitleModel) -> DataFrame:
    """(id, greedy, drawn): the ROUGE-L F of both titles of each article."""
    docs = titling.seeds(model, articles)
    made = [materialize(titling.seeded_titles(model, docs, mode, max_len=STEPS), "made-titles") for mode in ("greedy", "sample")]
    scored = evaluate.title_rewards(*made, titling.decoded_labels(model, titling.features(model, articles)))
    return materialize(scored.withColumn("id", F.col("id").cast("bigint")), "rewards")


@query
def o5_batch_rewards(spark, folder):
    articles, model = _title_model(spark, folder)
    rewards = evaluate.batch_rewards(_greedy_and_drawn(articles, model))
    return rewards.select("batch", _r("greedy_f"), _r("drawn_f"), _r("reward"))


@query
def o5_mixed_objective(spark, folder):
    """The documents in three parts, as the epochs of a run: the objective, with its reward on in epoch 1."""
    articles, model = _title_model(spark, folder)
    paths = titles.drawn_paths(titling.seeds(model, articles), cand.candidates(model.bigrams, "prev", "next", "sample"), STEPS, 11)
    features = titling.features(model, articles)
    nll = evaluate.token_nll(features, model.bigrams, TOP_N + 3).select("id", "nll")
    drawn = evaluate.drawn_loss(features, paths, model.bigrams, TOP_N + 3)
    rows = nll.join(drawn, "id").withColumn("id", F.col("id").cast("bigint")).join(_greedy_and_drawn(articles, model), "id")
    means = rows.groupBy((F.col("id") % 3).cast("int").alias("epoch")).agg(
        F.avg("nll").alias("loss"), F.avg("drawn_loss").alias("drawn_loss"), (F.avg("greedy") - F.avg("drawn")).alias("reward")
    )
    objective = evaluate.mixed_objective(F.col("loss"), F.col("reward"), F.col("drawn_loss"), 0.3, F.col("epoch"), 1)
    return means.select("epoch", _r("loss"), _r("drawn_loss"), _r("reward"), _r(objective, "objective"))


@query
def o6_best_checkpoints(spark, folder):
    articles, model = _title_model(spark, folder)
    nll = evaluate.token_nll(titling.features(model, articles), model.bigrams, TOP_N + 3).select("id", F.col("nll").alias("v_loss"))
    pairs = _lead_pairs(spark, folder)
    units = evaluate.units(pairs)
    scores = [
        evaluate.rouge_n(units, 1).select("id", F.col("f").alias("rouge_1")),
        evaluate.rouge_n(units, 2).select("id", F.col("f").alias("rouge_2")),
        evaluate.rouge_l(units).select("id", F.col("f").alias("rouge_l")),
    ]
    for score in scores:
        nll = nll.join(score, "id")
    step = (F.col("id").cast("bigint") % 10).cast("bigint")
    metrics = nll.groupBy(step.alias("step")).agg(*[F.round(F.avg(c), 9).alias(c) for c in ("v_loss", "rouge_1", "rouge_2", "rouge_l")])
    return evaluate.best_checkpoints(metrics).select("step", "name", _r("v_loss"))


@query
def o6_validation_job(spark, folder):
    log = scratch_path(spark, "metric-log")
    articles, model = _title_model(spark, folder)
    titling.validate(model, articles, log, 1, TOP_N + 3)
    return titling.best_validated(spark, log).select("step", *[_r(c) for c in ("v_loss", "rouge_1", "rouge_2", "rouge_l")])
