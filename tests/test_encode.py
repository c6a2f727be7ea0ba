import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexmill.operators import encode, prep, vocab


@pytest.fixture(scope="module")
def words(spark):
    df = spark.createDataFrame([("a a a a b b b c c  d d ",)], "t string")
    return vocab.corpus_vocab(df, "t", 100)


def encoded(spark, words, texts, length):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return encode.encode(df, words, "id", {"ids": ("t", length)}).orderBy("id")


def test_end_id_survives_the_cut(spark, words):
    rows = encoded(spark, words, ["a b", "a b c", "a b c d", "zzz", None], 4).collect()
    # By frequency then word: a, b, then '' (a word of double spaces), c and d with two each.
    assert [r.ids for r in rows] == [[3, 4, 1, 0], [3, 4, 6, 1], [3, 4, 6, 1], [2, 1, 0, 0], [5, 1, 0, 0]]


def test_decoder_start_both_ways(spark):
    df = spark.createDataFrame([([259, 5, 1, 0],), ([5, 6, 1, 0],), ([5, 6, 7, 1],)], "y array<int>")
    out = [r[0] for r in df.select(encode.decoder_start(F.col("y"), 4)).collect()]
    assert out == [[0, 5, 1, 0], [0, 5, 6, 1], [0, 5, 6, 7]]


def test_teacher_forcing(spark):
    df = spark.createDataFrame([(1, [5, 6, 1, 0, 0]), (2, [0, 0, 0, 0, 0]), (3, [259, 6, 1, 0, 0])], "id int, y array<int>")
    rows = {r.id: r for r in encode.teacher_forcing(df, "y", 5).collect()}
    assert rows[1].decoder_input_ids == [0, 5, 6, 1] and rows[1].labels == [5, 6, 1, -100]
    assert rows[1].decoder_attention_mask == [1, 1, 1, 0]
    assert rows[2].labels == [-100] * 4 and rows[2].decoder_attention_mask == [0] * 4
    assert rows[3].decoder_input_ids == [0, 6, 1, 0] and rows[3].labels == [6, 1, -100, -100]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "d", ""]), min_size=1, max_size=7).map(" ".join), min_size=1, max_size=6))
def test_decode_undoes_encode(spark, words, texts):
    ids = encoded(spark, words, texts, 8)
    out = encode.decode(ids, words, "id", "ids").orderBy("id").collect()
    assert [r.title for r in out] == texts


def test_decode_of_reserved_ids_is_empty(spark, words):
    df = spark.createDataFrame([(1, [0, 1, 2]), (2, [3, 1, 4])], "id int, ids array<int>")
    assert {r.id: r.title for r in encode.decode(df, words, "id", "ids").collect()} == {1: "", 2: "a b"}


def test_features_by_mode(spark, words):
    df = spark.createDataFrame([("12", "a（x）\nb", "c d")], "id string, maintext string, title string")
    train = encode.build_features(df, words, "train", 6, 4)
    assert train.columns == prep.TRAIN_COLUMNS
    row = train.first()
    assert row.input_ids == [2, 1, 0, 0, 0, 0] and row.attention_mask == [1, 1, 0, 0, 0, 0]
    assert row.decoder_input_ids == [0, 6, 7] and row.labels == [6, 7, 1]
    test = encode.build_features(df.drop("title"), words, "eval", 6)
    assert test.columns == prep.EVAL_COLUMNS and test.first().id == 12


def test_bad_ids_fail(spark):
    with pytest.raises(PySparkException):
        prep.numeric_id(spark.createDataFrame([("x1",)], "id string")).collect()


def test_mapped_features(spark):
    def double(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(twice=batch["id"] * 2)

    out = encode.map_features(spark.range(100).repartition(3), double, "id bigint, twice bigint")
    assert sum(r.twice for r in out.collect()) == 9900


def test_rows_of_one_key_stay_rows(spark):
    from lexmill.operators.encode import decode, encode

    words = spark.createDataFrame([("a", 3, 2), ("b", 4, 2)], "word string, token int, freq bigint")
    twice = spark.createDataFrame([(1, "a a"), (1, "b b")], "id bigint, text string")
    encoded = encode(twice, words, "id", {"ids": ("text", 4)})
    assert sorted((r.id, r.ids) for r in encoded.collect()) == [(1, [3, 3, 1, 0]), (1, [4, 4, 1, 0])]
    assert sorted((r.id, r.title) for r in decode(encoded, words, "id", "ids").collect()) == [(1, "a a"), (1, "b b")]


def test_words_of_a_small_vocabulary_are_encoded_in_place(spark, words, monkeypatch):
    df = spark.createDataFrame([(1, "a b c d a", "zz a"), (1, "", None), (None, " a", "b"), (2, None, "a b")], "id int, t string, u string")
    listed = lambda: sorted(str(tuple(r)) for r in encode.encode(df, words, "id", {"x": ("t", 4), "y": ("u", 1)}).collect())
    with monkeypatch.context() as m:
        m.setattr(encode, "list_lookup", lambda *a, **k: None)
        joined = listed()
    # Rows written to be told apart, or a join of the words, would fail here.
    monkeypatch.setattr(encode, "lookup_join", None)
    monkeypatch.setattr(encode, "materialize", None)
    assert listed() == joined and len(joined) == 4
