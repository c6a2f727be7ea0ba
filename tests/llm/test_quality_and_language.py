import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import langid, quality
from lexmill.llm.common import crc_mod

SYLLABLES = {"en": "th er on an ing re ti ed", "es": "que ción os ar ñ ado es la", "de": "sch ung ein ich ß zu ver en"}


def _word(rng, lang):
    return "".join(rng.choices(SYLLABLES[lang].split(), k=rng.choice([1, 2, 3])))


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(list(SYLLABLES))
        good = rng.random() < 0.7
        words = [_word(rng, lang) for _ in range(rng.choice([30, 100, 300]))]
        if not good:
            words = [w for x in words for w in [x] * 7] if rng.random() < 0.5 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), lang, "a"))
        labels.append((i, int(good) if i % 50 else None, 0))
    return make_docs(rows), spark.createDataFrame([*labels, (None, 1, 0), (9999, 0, 0)], "doc_id bigint, quality int, toxic int")


def test_quality_of_documents_that_were_held_out(labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    found = quality.score(docs, model).join(labels, "doc_id").where((crc_mod("doc_id", 4) == 2) & F.col("quality").isNotNull()).collect()
    assert len(found) > 50
    assert sum(r.predicted == r.quality for r in found) >= 0.97 * len(found)
    again = quality.fit(docs.repartition(5), labels)
    assert again.bias == model.bias and (again.weights == model.weights).all()


def test_several_shards_learn_too(labelled, monkeypatch):
    docs, labels = labelled
    monkeypatch.setattr(quality, "SHARD_DOCS", 100)
    found = quality.score(docs, quality.fit(docs, labels, max_docs=250)).join(labels, "doc_id").dropna(subset=["quality"]).collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)


def test_score_is_the_sparse_dot_product(labelled, make_docs):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    texts = ["One two two, three!!", "", None, "  ", "ünï 7", "a " * 70_000]
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in quality.score(make_docs([*rows, (None, "x"), (4, texts[4])]), model).collect()}
    empty = found[1]
    assert found[2].score == found[3].score == empty.score
    assert found[0].score != empty.score and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.predicted == (r.score >= 0.7) for r in found.values())
    docs = make_docs(rows)
    assert quality.keep(docs, model).columns == docs.columns
    assert quality.score(make_docs([]), model).collect() == []


def test_no_labels_give_even_scores(spark, make_docs):
    model = quality.fit(make_docs([(1, "a b")]), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert [r.score for r in quality.score(make_docs([(1, "a b")]), model).collect()] == [0.5]


def test_language_of_documents_that_were_held_out(labelled):
    docs, _ = labelled
    model = langid.fit(docs.where(crc_mod("doc_id", 3) != 1))
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(crc_mod("doc_id", 3) == 1).collect()
    assert len(found) > 80 and sum(r.lang_pred == r.lang for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_filters_hold_every_ngram_learned_and_say_how_often_they_err(labelled):
    model = langid.fit(labelled[0])
    assert model.languages == sorted(SYLLABLES) and (model.false_rates < 0.05).all()
    hits, total, letters = langid._hits(["ungein schein", "漢字漢字", "123"], model)
    assert hits[0].argmax() == model.languages.index("de") and letters.tolist() == [True, True, False]


def test_language_of_odd_texts(labelled, make_docs):
    model = langid.fit(labelled[0])
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "漢字"), (5, "thering " * 50_000), (6, "x"), (6, "x"), (None, "sch ung ein")]
    found = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(make_docs(rows), model).collect()]
    assert len(found) == 8
    by = {i: (la, s) for i, la, s in found}
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[4] == (model.languages[model.fallback], 0.0) and by[5][0] == "en" and by[None][0] == "de"


def test_no_language_learned(make_docs):
    model = langid.fit(make_docs([(1, "abc", None, "a"), (2, None, "en", "a")]))
    assert [(r.lang_pred, r.score) for r in langid.predict(make_docs([(1, "abc")]), model).collect()] == [("und", 0.0)]
    assert langid.predict(make_docs([]), model).collect() == []


def test_more_than_eight_languages(make_docs):
    rng = random.Random(6)
    rows = [(10 * k + i, " ".join("".join(rng.choices(chr(97 + k) + chr(98 + k), k=6)) for _ in range(60)), f"l{k:02}", "a") for k in range(20) for i in range(5)]
    docs = make_docs(rows)
    model = langid.fit(docs)
    assert len(model.filters) == 3
    assert all(r.lang_pred == f"l{r.doc_id // 10:02}" for r in langid.predict(docs, model).collect())
