"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column of :func:`numbered`.
ROW = "_row_number"

_LOCAL_SCRATCH: dict[str, str] = {}
#: The folders of the open :func:`released` blocks, innermost last.
_RELEASED: ContextVar[tuple[str, ...]] = ContextVar("released", default=())


class Size(NamedTuple):
    rows: int
    bytes: int


_SIZES: weakref.WeakKeyDictionary[DataFrame, Size] = weakref.WeakKeyDictionary()


def local_session(name: str = "lexmill", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter's session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors would not see
    each other's files, and losing one would lose its part of the table.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/lexmill-{spark.sparkContext.applicationId}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="lexmill-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app], ignore_errors=True)
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    folder = scratch_dir(spark)
    inner = [f for f in _RELEASED.get() if f.startswith(f"{folder}/")]
    return f"{inner[-1] if inner else folder}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """``path`` and its file system, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are deleted at its end, also if it fails.

    Frames made inside read these tables, so write or collect what is to stay before the block ends. Blocks may be nested.
    """
    folder = scratch_path(spark, "released")
    token = _RELEASED.set((*_RELEASED.get(), folder))
    try:
        yield
    finally:
        _RELEASED.reset(token)
        path, fs = hadoop_path(spark, folder)
        fs.delete(path, True)


def _measures(df: DataFrame) -> list[Column]:
    """Aggregates of the rows and of about the bytes they take in memory."""
    fixed, varying = 0, F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            varying = varying + F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            varying = varying + F.greatest(F.size(f"`{field.name}`"), F.lit(0)) * 48
        fixed += 16
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(varying + fixed), F.lit(0)).alias("bytes")]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives Catalyst real file sizes to plan with. Its
    rows and bytes are counted as they are written, so :func:`measure` needs no job of its own.
    """
    path, size = scratch_path(df.sparkSession, name), Observation()
    df.observe(size, *_measures(df)).write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if {"rows", "bytes"} <= (seen := size.get).keys():
        _SIZES[written] = Size(seen["rows"], seen["bytes"])
    return written


def sized(df: DataFrame, like: DataFrame | Size) -> DataFrame:
    """``df``, a projection or a part of the measured ``like``, with the size of that as a bound of its own; or with a known size."""
    _SIZES[df] = like if isinstance(like, Size) else measure(like)
    return df


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row. Write it before rows move, so that a row keeps its number."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def measure(df: DataFrame) -> Size:
    """The size of ``df``: as counted when it was written, else by a job, once per DataFrame object."""
    if df not in _SIZES:
        _SIZES[df] = Size(*df.agg(*_measures(df)).first())
    return _SIZES[df]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out by ``key`` if the input has fewer splits than the session has cores.

    A large corpus comes in many splits and stays where it is; a few unsplittable files would leave
    most cores idle through all the work on their texts.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
