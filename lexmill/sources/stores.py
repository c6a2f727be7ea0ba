"""Parquet stores of features and metrics."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.scale import fits_broadcast
from lexmill.runtime import hadoop_path, materialize

#: Buckets of ids in a store; a changed row has its bucket written again, so take more where a bucket would be large.
BUCKETS = 64
GENERATION, BUCKET = "store_generation", "store_bucket"
#: The bucket, and the measures of the rows, of a key.
OF, MEASURES = "of_bucket", ("n", "x", "s")


def _row_measures(columns: Sequence[str | Column]) -> list[Column]:
    """Aggregates that change with the values of any row, whatever the order of the rows."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    h = F.xxhash64(*columns, *[c.isNull() for c in columns])
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s")]


def _row_key(row) -> str:
    return f"{row.n}-{(row.x or 0) & 0xFFFFFFFFFFFFFFFF:016x}-{int(row.s or 0) & 0xFFFFFFFFFFFFFFFFFFFFFFFF:x}"


def rows_key(df: DataFrame, *columns: str | Column) -> str:
    """A key that changes with the values of any row, whatever the order of the rows."""
    return _row_key(df.agg(*_row_measures(columns)).first())


def vocab_key(vocab: DataFrame) -> str:
    """A key that changes with any word, class or position of a vocabulary, whatever the row order."""
    return rows_key(vocab, *[c for c in ("cls", "word", "idx", "token") if c in vocab.columns])


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = hadoop_path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def _versions(spark: SparkSession, root: str) -> list[str]:
    """The published versions of a store, oldest first."""
    return [n for n in _names(spark, f"{root}/published") if n.endswith(".json")]


def _version(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{root}/published/{name}", wholetext=True).first().value)


def _newest(spark: SparkSession, root: str) -> dict | None:
    names = _versions(spark, root)
    return _version(spark, root, names[-1]) if names else None


def _publish(spark: SparkSession, root: str, version: dict) -> None:
    """Make ``version`` the newest: its file is written aside and appears whole, by one renaming.

    Of two writers at the same time the one that is last by number, then name, counts; what either names is whole.
    """
    number = 1 + max((int(n.split("-")[0]) for n in _versions(spark, root)), default=0)
    name = f"{number:012d}-{uuid.uuid4().hex}.json"
    aside, fs = hadoop_path(spark, f"{root}/aside/{name}")
    out = fs.create(aside)
    out.writeBytes(json.dumps(version))
    out.close()
    target, _ = hadoop_path(spark, f"{root}/published/{name}")
    fs.mkdirs(target.getParent())
    if not fs.rename(aside, target):
        raise OSError(f"could not publish {target}")


def _write(rows: DataFrame, root: str, parts: Sequence[str], also: DataFrame | None = None, bucket: str = BUCKET, under: str = "data") -> dict[str, str]:
    """Write ``rows`` (with their bucket) as a generation of its own, and the rows of ``also``, which come in files of few buckets; the folder of each bucket that has rows."""
    generation = f"{GENERATION}=g{uuid.uuid4().hex}"
    rows = rows.hint("rebalance", bucket)
    rows = rows if also is None else also.unionByName(rows)
    rows.write.partitionBy(bucket, *parts).parquet(f"{root}/{under}/{generation}")
    written = _names(rows.sparkSession, f"{root}/{under}/{generation}")
    return {n.split("=")[1]: f"{generation}/{n}" for n in written if n.startswith(f"{bucket}=")}


def _read(spark: SparkSession, root: str, version: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets: only the folders that it names are listed and read."""
    schema = T.StructType.fromJson(version["schema"])
    folders = [f"{root}/data/{b['folder']}" for n, b in version["buckets"].items() if b["folder"] and (buckets is None or int(n) in buckets)]
    if not folders:
        return spark.createDataFrame([], schema)
    place = T.StructType([*schema, T.StructField(GENERATION, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(place).option("basePath", f"{root}/data").parquet(*folders).select(*schema.names)


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def _without(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """The ``rows`` whose key is (``left_semi``) or is not (``left_anti``) among the written ``keys``, a null one included."""
    return rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys, F.col(f"`{key}`").eqNullSafe(F.col("_key")), how)


def _changed_keys(now: DataFrame, before: DataFrame) -> DataFrame:
    """(_key) of the keys with other rows ``now`` than ``before`` (both _key, n, x, s), or with rows in one of them only; written."""
    a, b = (df.select("_key", F.struct(*MEASURES).alias(name)) for df, name in ((now, "now"), (before, "before")))
    b = b.withColumnRenamed("_key", "_old")
    both = a.join(b, F.col("_key").eqNullSafe(F.col("_old")), "full_outer").where(~F.col("now").eqNullSafe(F.col("before")))
    return materialize(both.select(F.when(F.col("now").isNull(), F.col("_old")).otherwise(F.col("_key")).alias("_key")), "changed-keys")


def bucket_store(
    root: str, source: DataFrame, key: str, columns: Sequence[str], build: Callable[[DataFrame], DataFrame],
    parts: Sequence[str] = (), buckets: int = BUCKETS, rebuild: bool = False,
) -> DataFrame:
    """What ``build`` makes of the ``source``, kept under ``root``; only keys of which a row changed are built again, and only their buckets written.

    ``build(rows)`` gets the rows of the changed keys and must judge each key by its own rows; its result keeps ``key``. A key changed if any
    value in ``columns`` did, or a row came or went; measures of the rows of each key are kept beside the data. Other keys of a changed bucket are copied from the
    version before, unless that has other columns than ``build`` gives, or no measures: then its changed buckets are built whole. Unchanged buckets are taken
    over as files. ``parts`` partition the files.

    The new version appears by one renaming when all is written: readers see the old rows or the new, a frame read before goes on
    reading the old ones, and a job that is lost on the way leaves what was. :func:`drop_versions` deletes what no kept version
    names. The driver holds one key per bucket.
    """
    spark = source.sparkSession
    bucket = lambda column: F.pmod(F.xxhash64(F.col(f"`{column}`").cast("string")), F.lit(buckets)).cast("int")
    keys = materialize(source.groupBy(F.col(f"`{key}`").alias("_key")).agg(*_row_measures(columns)).withColumn(OF, bucket("_key")), "store-keys")
    sums = keys.groupBy(OF).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))
    now = {str(r[OF]): f"{buckets}/{_row_key(r)}" for r in sums.collect()}
    old = _newest(spark, root)
    held = old["buckets"] if old and not rebuild else {}
    changed = sorted(int(b) for b, k in now.items() if b not in held or held[b]["key"] != k)
    if old is None or changed or held.keys() != now.keys():
        whole = source.where(bucket(key).isin(changed))
        known = [b for b in changed if held.get(str(b), {}).get("measures")]
        built, kept = None, None
        if known:
            before = spark.read.schema(keys.drop(OF).schema).parquet(*[f"{root}/keys/{held[str(b)]['measures']}" for b in known])
            others = _changed_keys(keys.where(F.col(OF).isin(changed)), before)
            built = build(_without(whole, others, key, "left_semi"))
            kept = _without(_read(spark, root, old, known), others, key, "left_anti").withColumn(BUCKET, bucket(key))
        if built is None or not _same_columns(built.schema, kept.drop(BUCKET).schema):
            built, kept = build(whole), None
        folders = _write(built.withColumn(BUCKET, bucket(key)), root, parts, kept) if changed else {}
        measures = _write(keys.where(F.col(OF).isin(changed)), root, (), None, OF, "keys") if changed else {}
        new = {b: {"key": k, "folder": folders.get(b), "measures": measures.get(b)} if int(b) in changed else held[b] for b, k in now.items()}
        old = {"schema": built.schema.jsonValue(), "buckets": new}
        _publish(spark, root, old)
    return _read(spark, root, old)


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions of a store and the files that only these name; the number of folders deleted.

    Frames read from a deleted version fail. A writer at work must not run at the same time: what it wrote is not named yet.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    names = _versions(spark, root)
    kept = {b.get(at) for n in names[-keep:] for b in _version(spark, root, n)["buckets"].values() for at in ("folder", "measures")}
    for name in names[:-keep]:
        path, fs = hadoop_path(spark, f"{root}/published/{name}")
        fs.delete(path, False)

    def unnamed(under: str, bucket: str) -> list[str]:
        folders = [f"{g}/{b}" for g in _names(spark, f"{root}/{under}") for b in _names(spark, f"{root}/{under}/{g}") if b.startswith(f"{bucket}=")]
        return [f"{root}/{under}/{f}" for f in folders if f not in kept]

    gone = unnamed("data", BUCKET)
    for folder in (*gone, *unnamed("keys", OF)):
        path, fs = hadoop_path(spark, folder)
        fs.delete(path, True)
    return len(gone)


def bag_store(
    spark: SparkSession, root: str, vocab: DataFrame, reviews: DataFrame, build: Callable[[DataFrame], DataFrame],
    rebuild: bool = False, buckets: int = BUCKETS,
) -> DataFrame:
    """The bag of words of all splits, built once per vocabulary and documents and read back after that.

    ``build(rows)`` returns a bag of these ``reviews`` (Id, text, split) with a ``split`` column, which partitions the table. Another
    vocabulary gives another store; the rows of an id of which a text or split changed are built again (:func:`bucket_store`).
    """
    path = f"{root}/bag/vocab={vocab_key(vocab)}"
    return bucket_store(path, reviews, "Id", ("Id", "text", "split"), build, ("split",), buckets, rebuild)


def features_path(root: str, mode: str, tokenizer: str, max_len: int, made_from: str = "") -> str:
    """The folder of one key; names are quoted, so a tokenizer may be called anything."""
    return f"{root}/features/{quote(mode, safe='')}/{quote(tokenizer, safe='')}/{max_len}/{quote(made_from, safe='') or 'any'}"


def write_features(features: DataFrame, root: str, mode: str, tokenizer: str, max_len: int, made_from: str = "") -> None:
    """Store encoded features under (mode, tokenizer, max_len, made_from), replacing only that key, for readers at one moment."""
    path = features_path(root, mode, tokenizer, max_len, made_from)
    folders = _write(features.withColumn(BUCKET, F.lit(0)), path, ())
    version = {"schema": features.schema.jsonValue(), "buckets": {"0": {"key": "", "folder": folders.get("0")}}}
    _publish(features.sparkSession, path, version)


def read_features(spark: SparkSession, root: str, mode: str, tokenizer: str, max_len: int, made_from: str = "") -> DataFrame | None:
    """The stored features of the key, or None; only the key's folder is read."""
    path = features_path(root, mode, tokenizer, max_len, made_from)
    version = _newest(spark, path)
    return _read(spark, path, version) if version else None


def feature_store(
    spark: SparkSession, root: str, mode: str, tokenizer: str, max_len: int, build: Callable[[], DataFrame], made_from: str = ""
) -> DataFrame:
    """Read the features of a key, building and storing them first where there are none.

    ``made_from`` tells what else the features depend on: the keys of the articles and of the vocabulary
    (:func:`rows_key`, :func:`vocab_key`) and the length of the titles.
    """
    stored = read_features(spark, root, mode, tokenizer, max_len, made_from)
    if stored is None:
        write_features(build(), root, mode, tokenizer, max_len, made_from)
        stored = read_features(spark, root, mode, tokenizer, max_len, made_from)
    return stored


def article_features(
    root: str, articles: DataFrame, mode: str, tokenizer: str, max_len: int, build: Callable[[DataFrame], DataFrame],
    made_from: str = "", buckets: int = BUCKETS,
) -> DataFrame:
    """As :func:`feature_store` for ``articles`` (id, maintext, title), of which only changed ids are encoded again.

    ``build(rows)`` returns the features of these articles with their ``id``; ``made_from`` names the vocabulary and the length
    of the titles, not the articles.
    """
    path = features_path(f"{root}/articles", mode, tokenizer, max_len, made_from)
    return bucket_store(path, articles, "id", ("id", "maintext", "title"), build, (), buckets)


def long_metrics(wide: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Named values as rows (keys…, metric, value); missing values leave no row."""
    doubles = wide.select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
    return doubles.unpivot(keys, values, "metric", "value").where(F.col("value").isNotNull())


def append_metrics(wide: DataFrame, root: str, keys: list[str], values: list[str]) -> None:
    long_metrics(wide, keys, values).write.mode("append").parquet(f"{root}/metrics")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/metrics")
