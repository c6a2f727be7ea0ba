from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexmill.operators import scale
from lexmill.operators.prep import assign_batches
from lexmill.runtime import materialize, measure, scratch_dir, spread


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group."""
    return spark.range(3_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 10)).alias("grp"), (F.col("id") * 37 % 1009).alias("v")
    )


def test_order_index_matches_a_plain_ranking(spark, skewed):
    got = {r.id: r.pos for r in scale.with_order_index(skewed, "pos", [F.desc("v"), F.col("id")], ["grp"]).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r.grp, []).append((-r.v, r.id))
    want = {i: n for rows in groups.values() for n, (_, i) in enumerate(sorted(rows))}
    assert got == want


def test_order_index_spreads_one_group_over_the_slices(spark, skewed):
    slices = scale._slices(skewed.where("grp = 'hot'"), ["grp"], [F.col("v"), F.col("id")])
    sizes = [r["count"] for r in slices.groupBy("_slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1_000 * 0.6


@pytest.mark.parametrize("partitions", [1, 8])
def test_running_totals_do_not_depend_on_partitions(spark, skewed, partitions):
    rows = scale.with_running_totals(skewed.repartition(partitions), [F.col("v"), F.col("id")], ["grp"], total="v")
    got = {r.id: (r.rows_so_far, r.total) for r in rows.collect()}
    sums, want = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: (r.v, r.id)):
        n, s = sums.get(r.grp, (0, 0))
        sums[r.grp] = want[r.id] = (n + 1, s + r.v)
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_the_same_beyond_the_broadcast_bound(spark, skewed, how):
    looked_up = spark.createDataFrame([("hot", 1), ("g1", 2), ("g1", 3), ("g7", 4), ("none", 5)], "grp string, w int")
    small = scale.lookup_join(skewed, looked_up, ["grp"], how)
    big = scale.lookup_join(skewed, looked_up, ["grp"], how, max_rows=0)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, big.collect()), key=str)
    assert small.columns == big.columns


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_rows", [1, 2, 3])
def test_two_tiers_give_the_same_rows(spark, skewed, how, max_rows):
    looked_up = spark.createDataFrame([("hot", 1), ("g1", 2), ("g1", 3), ("g7", 4), ("none", 5)], "grp string, w int")
    small = scale.lookup_join(skewed, looked_up, ["grp"], how)
    tiered = scale.lookup_join(skewed, materialize(looked_up, "up"), ["grp"], how, max_rows=max_rows)
    assert small.columns == tiered.columns
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, tiered.collect()), key=str)


def test_most_words_meet_the_head(spark, small):
    words = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    vocab = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).where("freq > 2").withColumn("idx", F.xxhash64("word")), "vocab")
    near, head, far, tail = scale.tiers(words, vocab, ["word"], 1000, 1 << 20)
    n = words.count()
    best = words.groupBy("word").count().orderBy(F.desc("count")).limit(1000).agg(F.sum("count")).first()[0]
    assert vocab.count() > 5_000 and head.count() <= 1000 and near.count() + far.count() == n
    # No thousand words of this text cover more.
    print(best / n, near.count() / n)
    assert near.count() >= 0.93 * best
    joined = scale.lookup_join(words, vocab, ["word"], "left", max_rows=1000)
    assert joined.exceptAll(scale.lookup_join(words, vocab, ["word"], "left")).isEmpty() and joined.count() == n


def test_a_hot_key_outside_the_head_gets_its_share_of_salts(spark, skewed):
    looked_up = materialize(spark.createDataFrame([("hot", i) for i in range(5)] + [("g1", 2)], "grp string, w int"), "up")
    near, head, far, tail = scale.tiers(skewed, looked_up, ["grp"], 3, 1 << 20)
    assert near is not None and head.where("grp = 'hot'").isEmpty()
    salts = {r.grp: r.n for r in tail.groupBy("grp").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert salts["hot"] == 2 and salts["g1"] == 1


def test_lookup_join_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    right = spark.createDataFrame([("a", 9)], "k string, w int")
    out = scale.lookup_join(left, right, ["k"], "left", max_rows=0)
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 2, 9), (None, 1, None)]
    nulls = spark.range(1_000).select("id", F.lit(None).cast("string").alias("k"))
    spread_out = scale.lookup_join(nulls, right, ["k"], "left", max_rows=0)
    assert spread_out.count() == 1_000
    assert spread_out.columns == ["k", "id", "w"]


def test_hot_keys_are_salted(spark):
    left = spark.range(40_000).withColumn("k", F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")))
    right = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    out = scale.lookup_join(left, right, ["k"], max_bytes=0)
    assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 40_000


def test_batches_are_full_but_for_the_last(spark):
    df = spark.range(103).withColumn("split", F.lit("a"))
    sizes = sorted(r["count"] for r in assign_batches(df, 10, "id", ("split",)).groupBy("batch").count().collect())
    assert sizes == [3] + [10] * 10
    shuffled = assign_batches(df, 10, "id", ("split",), shuffle_seed=1)
    again = assign_batches(df.repartition(5), 10, "id", ("split",), shuffle_seed=1)
    assert {(r.id, r.batch) for r in shuffled.collect()} == {(r.id, r.batch) for r in again.collect()}
    assert {(r.id, r.batch) for r in shuffled.collect()} != {(r.id, r.id // 10) for r in df.collect()}


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("a", F.array("id"))
    out = materialize(df, "t")
    assert out.dtypes == df.dtypes and out.count() == 10
    assert measure(out).rows == 10


def test_the_shared_folder_comes_from_the_session(spark):
    def session(**conf):
        settings = {k.replace("_", "."): v for k, v in conf.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)), sparkContext=SimpleNamespace(applicationId="app-1"))

    assert scratch_dir(session(spark_checkpoint_dir="/shared/place/", spark_master="yarn")) == "/shared/place/lexmill-app-1"
    with pytest.raises(RuntimeError):
        scratch_dir(session(spark_master="yarn"))
    assert scratch_dir(spark) == scratch_dir(spark)


def test_spread_leaves_inputs_with_enough_splits(spark):
    many = spark.range(0, 100, 1, 16)
    assert spread(many, "id") is many
    assert spread(many.coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_list_lookup_is_a_join_of_whole_arrays(spark):
    table = spark.createDataFrame([("a", 3), ("", 4), ("é", 5)], "word string, token bigint")
    lists = [["a", "x", "", "é"], [], None, ["x"], ["a"] * 3]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "i int, words array<string>").repartition(2)
    found = scale.list_lookup(table, "word", "token")(F.col("words"))
    other = scale.list_lookup(table, "word", "token", missing=2)(F.col("words"))
    got = {r.i: (r.a, r.b) for r in df.select("i", found.alias("a"), other.alias("b")).collect()}
    assert got == {0: ([3, None, 4, 5], [3, 2, 4, 5]), 1: ([], []), 2: ([], []), 3: ([None], [2]), 4: ([3] * 3, [3] * 3)}
    none = scale.list_lookup(table.limit(0), "word", "token")(F.col("words"))
    assert df.where("i = 4").select(none.alias("a")).first().a == [None] * 3


def test_list_lookup_leaves_what_only_a_join_can_tell(spark):
    schema = "word string, token int"
    for rows in ([("a", 1), ("a", 2)], [("a", 1), (None, 2)], [("a", None)]):
        assert scale.list_lookup(spark.createDataFrame(rows, schema), "word", "token") is None
    assert scale.list_lookup(spark.createDataFrame([("a", 1)], schema), "word", "token", max_rows=0) is None
