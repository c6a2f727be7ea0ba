from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexmill.operators import vocab
from lexmill.sources import files, stores


def test_csv_with_commas_quotes_and_newlines(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('Id,Category,text\n1,0,"a, ""q""\nb"\n2,1,plain words\n3,1,NA\n4,0,\n', encoding="utf-8")
    rows = [tuple(r) for r in files.read_reviews(spark, str(path)).orderBy("Id").collect()]
    assert rows == [(1, 0, 'a, "q"\nb'), (2, 1, "plain words"), (3, 1, "NA"), (4, 0, None)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "test.csv"
    path.write_text("text,Id\nx y,7\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_reviews(spark, str(path), labelled=False).collect()] == [(7, None, "x y")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, ' lead, "q" \n x '), (2, None, "好"), (3, 1, "a\\b")], "Id bigint, Category int, text string")
    files.write_reviews(df, str(tmp_path / "r"))
    assert sorted(map(tuple, files.read_reviews(spark, str(tmp_path / "r")).collect())) == sorted(map(tuple, df.collect()))


def test_articles_without_titles(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "12", "maintext": "正文\\nx"}\n{"id": "3", "maintext": "y", "title": "標題"}\n', encoding="utf-8")
    rows = sorted(map(tuple, files.read_articles(spark, str(path)).collect()))
    assert rows == [("12", "正文\nx", None), ("3", "y", "標題")]


def test_titles_keep_unicode_and_blank_ones_get_the_placeholder(spark, tmp_path):
    df = spark.createDataFrame([("1", "標題"), ("2", ""), ("3", None)], "id string, title string")
    files.write_titles(df.coalesce(1), str(tmp_path / "t"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "t").glob("*.json"))
    assert '{"title":"標題","id":1}' in text and text.count("無") == 2
    assert files.read_titles(spark, str(tmp_path / "t")).count() == 3


def test_answers(spark, tmp_path):
    files.write_answers(spark.createDataFrame([(5, 1)], "Id bigint, pred int").coalesce(1), str(tmp_path / "a"))
    assert next((tmp_path / "a").glob("*.csv")).read_text() == "Id,Category\n5,1\n"
    assert [tuple(r) for r in files.read_answers(spark, str(tmp_path / "a")).collect()] == [(5, 1)]


def test_bag_store_is_built_once_per_vocabulary(spark, tmp_path):
    calls = []

    def build(rows):
        calls.append(1)
        return spark.createDataFrame([(1, "neg", 0, 2, "train"), (2, "pos", 1, 1, "test")], "Id bigint, cls string, idx bigint, cnt bigint, split string")

    words = spark.createDataFrame([("neg", "a", 0, 11), ("pos", "b", 1, 12)], "cls string, word string, idx bigint, freq bigint")
    reviews = spark.createDataFrame([(1, "a a", "train"), (2, "b", "test")], "Id bigint, text string, split string")
    for _ in range(2):
        bag = stores.bag_store(spark, str(tmp_path), words.repartition(3), reviews, build)
    assert len(calls) == 1 and bag.where("split = 'test'").count() == 1
    changed = words.withColumn("word", F.concat("word", F.lit("x")))
    stores.bag_store(spark, str(tmp_path), changed, reviews, build)
    stores.bag_store(spark, str(tmp_path), words, reviews, build, rebuild=True)
    assert len(calls) == 3
    stores.bag_store(spark, str(tmp_path), words, reviews.withColumn("text", F.concat("text", F.lit(" a"))), build)
    assert len(calls) == 4
    assert stores.vocab_key(words) == stores.vocab_key(words.orderBy(F.desc("word"))) != stores.vocab_key(changed)


def test_feature_store_replaces_only_its_key(spark, tmp_path):
    root = str(tmp_path)
    assert stores.read_features(spark, root, "train", "w", 4) is None
    stores.write_features(spark.range(3), root, "train", "w", 4)
    stores.write_features(spark.range(5), root, "train", "w", 8)
    stores.write_features(spark.range(2), root, "train", "w", 4)
    assert stores.read_features(spark, root, "train", "w", 4).count() == 2
    assert stores.read_features(spark, root, "train", "w", 8).count() == 5
    assert stores.read_features(spark, root, "eval", "w", 4) is None
    assert stores.read_features(spark, root, "train", "w", 4, "other articles") is None


def test_a_store_that_was_not_finished_does_not_count(spark, tmp_path):
    stores.write_features(spark.range(3), str(tmp_path), "train", "1.0/x", 4)
    path = stores.features_path(str(tmp_path), "train", "1.0/x", 4)
    assert stores.read_features(spark, str(tmp_path), "train", "1.0/x", 4).count() == 3
    for mark in (Path(path) / "published").glob("*.json"):
        mark.unlink()
    assert stores.read_features(spark, str(tmp_path), "train", "1.0/x", 4) is None


@pytest.mark.parametrize(("name", "text", "read"), [
    ("a.csv", "Id,Category,text\n1,0,x\nx2,oops,bad\n", files.read_reviews),
    ("a.jsonl", '{"id": "1", "maintext": "x"}\n{broken\n', files.read_articles),
    ("b.csv", "Id,Category\n1,0\nx,y\n", files.read_answers),
])
def test_broken_input_raises(spark, tmp_path, name, text, read):
    (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read(spark, str(tmp_path / name)).collect()


def test_metric_log_appends_long_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, 0.5, None), (1, 20, 0.25, 2.0)], "epoch int, step int, t_loss double, rl_loss double")
    stores.append_metrics(df.where("step = 10"), str(tmp_path), ["epoch", "step"], ["t_loss", "rl_loss"])
    stores.append_metrics(df.where("step = 20"), str(tmp_path), ["epoch", "step"], ["t_loss", "rl_loss"])
    rows = sorted(map(tuple, stores.read_metrics(spark, str(tmp_path)).collect()))
    assert rows == [(1, 10, "t_loss", 0.5), (1, 20, "rl_loss", 2.0), (1, 20, "t_loss", 0.25)]


def test_vectors_and_long_bag_agree(spark):
    from pyspark.ml.functions import vector_to_array

    from lexmill.operators.models import add_vectors

    df = spark.createDataFrame([(i, i % 2, "a b b " * 6 + str(i)) for i in range(6)] + [(9, None, None)], "Id bigint, Category int, text string")
    words = vocab.build_vocab(df)
    vectors = add_vectors(df, words).select("Id", *[vector_to_array(f"{v}_features").alias(v) for v in ("neg", "pos")])
    dense = {(r.Id, v, i, int(c)) for r in vectors.collect() for v in ("neg", "pos") for i, c in enumerate(r[v]) if c}
    assert dense == {tuple(r) for r in vocab.bag_of_words(df, words).collect()}


def test_one_broken_line_in_a_thousand_is_rejected(spark, tmp_path):
    lines = [f'{{"id": "{i}", "maintext": "text {i}", "title": "t"}}' for i in range(1000)]
    lines[500] = '{"id": "500", "maintext": '
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    good, rejects = files.read_articles_or_reject(spark, str(tmp_path / "a.jsonl"), limit=1)
    assert good.count() == 999 and good.columns == ["id", "maintext", "title"]
    assert [(r.file.rsplit("/", 1)[-1], r.line) for r in rejects.collect()] == [("a.jsonl", lines[500])]
    rows = [f'{i},{i % 2},"text, {i}"' for i in range(1000)]
    rows[7] = '7,many,"text"'
    (tmp_path / "r.csv").write_text("Id,Category,text\n" + "\n".join(rows) + "\n")
    for multi_line in (True, False):
        good, rejects = files.read_reviews_or_reject(spark, str(tmp_path / "r.csv"), limit=1, multi_line=multi_line)
        assert good.count() == 999 and [r.line.strip() for r in rejects.collect()] == [rows[7]]
    with pytest.raises(ValueError, match="more than the limit of 0"):
        files.read_articles_or_reject(spark, str(tmp_path / "a.jsonl"), limit=0)


def _folders(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("store_bucket=*")}


def test_a_changed_review_rewrites_one_bucket(spark, tmp_path):
    rows = [(i, i % 2, f"a b{i % 7} a", "train" if i % 3 else "test") for i in range(200)] + [(900, 0, None, "test")]
    schema = "Id bigint, Category int, text string, split string"
    reviews = spark.createDataFrame(rows, schema)
    words = vocab.build_vocab(reviews)
    seen = []

    def build(part):
        seen.append(sorted(r.Id for r in part.select("Id").collect()))
        return vocab.bag_of_words(part, words).join(part.select("Id", "split"), "Id")

    def bag(df):
        return stores.bag_store(spark, str(tmp_path), words, df, build, buckets=16)

    def whole(df):
        return sorted(map(tuple, vocab.bag_of_words(df, words).join(df.select("Id", "split"), "Id").select("Id", "cls", "idx", "cnt", "split").collect()))

    def stored(df):
        return sorted(map(tuple, df.select("Id", "cls", "idx", "cnt", "split").collect()))

    first = bag(reviews)
    folders = _folders(tmp_path)
    assert stored(first) == whole(reviews) and stored(bag(reviews)) == whole(reviews) and len(seen) == 1
    changed = spark.createDataFrame([(i, c, "b1 b2" if i == 5 else t, s) for i, c, t, s in rows], schema)
    second = bag(changed)
    assert len(seen) == 2 and 5 in seen[1] and len(seen[1]) < 40
    assert len(_folders(tmp_path) - folders) == 1
    assert stored(second) == whole(changed) and stored(first) == whole(reviews)
    fewer = changed.where("Id <> 5")
    assert stored(bag(fewer)) == whole(fewer) and len(seen) == 3
    root = str(next((tmp_path / "bag").iterdir()))
    assert stores.drop_versions(spark, root, keep=1) == 2
    assert stored(bag(fewer)) == whole(fewer) and len(seen) == 3
    empty = fewer.where("Id < 0")
    assert stored(bag(empty)) == [] and stored(bag(reviews)) == whole(reviews)


def test_readers_see_a_whole_version_while_another_is_written(spark, tmp_path):
    root = str(tmp_path)
    stores.write_features(spark.range(3), root, "train", "w", 4)
    before = stores.read_features(spark, root, "train", "w", 4)
    during = []

    def look(rows):
        during.append(stores.read_features(spark, root, "train", "w", 4).count())
        return rows

    stores.write_features(look(spark.range(5)), root, "train", "w", 4)
    assert during == [3] and before.count() == 3 and stores.read_features(spark, root, "train", "w", 4).count() == 5
    broken = spark.range(7).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        stores.write_features(broken, root, "train", "w", 4)
    assert stores.read_features(spark, root, "train", "w", 4).count() == 5


def test_article_features_are_encoded_again_only_where_changed(spark, tmp_path):
    rows = [(str(i), f"text {i}", None if i % 5 == 0 else f"title {i}") for i in range(60)]
    schema, seen = "id string, maintext string, title string", []

    def build(part):
        seen.append(part.count())
        return part.select("id", F.length("maintext").alias("n"), F.length("title").alias("m"))

    def run(rows):
        return sorted(map(repr, stores.article_features(str(tmp_path), spark.createDataFrame(rows, schema), "train", "w", 4, build, buckets=8).collect()))

    first = run(rows)
    moved = [*rows[:-1], ("59", None, "text 59")]
    assert len(first) == 60 and run(moved) != first and len(seen) == 2 and seen[0] == 60 and 0 < seen[1] < 30
    assert run(rows) == first


def test_released_blocks_leave_no_table_behind(spark, tmp_path):
    from lexmill import runtime

    folder = Path(runtime.scratch_dir(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    with runtime.released(spark):
        outer = runtime.materialize(spark.range(5), "outer")
        with runtime.released(spark):
            runtime.materialize(spark.range(9), "inner").write.parquet(str(tmp_path / "kept"))
        assert outer.count() == 5
    with pytest.raises(ValueError, match="stop"), runtime.released(spark):
        runtime.materialize(spark.range(5), "lost")
        raise ValueError("stop")
    assert (set(folder.iterdir()) if folder.exists() else set()) == before
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 9


def test_only_changed_ids_are_built_again_and_the_others_of_their_bucket_stay(spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(60)] + [(7, "again"), (None, "none"), (None, "null")]
    seen = []

    def store(rows, named="t"):
        def build(part):
            seen.append(sorted(((r.k, r.t) for r in part.collect()), key=str))
            return part.select("k", F.upper("t").alias(named), F.when(F.col("k") % 2 == 0, "a").otherwise("b").alias("p"))

        df = stores.bucket_store(str(tmp_path), spark.createDataFrame(rows, "k bigint, t string"), "k", ("k", "t"), build, ("p",), buckets=4)
        return sorted(((r.k, r[named]) for r in df.collect()), key=str)

    def made(rows):
        return sorted(((k, t.upper()) for k, t in rows), key=str)

    assert store(rows) == made(rows) and len(seen[-1]) == 63
    # A changed row of a repeated id, a new id, one that went, and a changed row without an id.
    changed = [(k, {"again": "other", "null": "nil"}.get(t, t)) for k, t in rows if k != 9] + [(100, "new")]
    assert store(changed) == made(changed)
    assert seen[-1] == sorted([(7, "t7"), (7, "other"), (100, "new"), (None, "none"), (None, "nil")], key=str)
    # A build with other columns gets whole buckets, and so does a store from before measures of keys were kept.
    renamed = [(k, "x" if k == 3 else t) for k, t in changed]
    assert set(made(renamed)) >= {(k, t) for k, t in store(renamed, "u") if t is not None} and len(seen[-1]) > 5
    assert store(rows) == made(rows)
    for keys in (tmp_path / "published").glob("*.json"):
        keys.write_text(keys.read_text().replace('"measures"', '"nothing"'))
        (keys.parent / f".{keys.name}.crc").unlink(missing_ok=True)
    assert store(changed) == made(changed) and len(seen[-1]) > 5
    stores.drop_versions(spark, str(tmp_path), keep=1)
    assert store(changed[1:]) == made(changed[1:]) and seen[-1] == []
