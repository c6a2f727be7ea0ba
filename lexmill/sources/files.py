"""CSV and JSON Lines inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.evaluate import or_placeholder
from lexmill.runtime import materialize

ARTICLE_SCHEMA = "id string, maintext string, title string"


def _csv(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, multiLine=multi_line, quote='"', escape='"', mode="FAILFAST")


def read_reviews(spark: SparkSession, path: str, labelled: bool = True, multi_line: bool = True) -> DataFrame:
    """(Id, Category, text). Quoted fields may hold commas, doubled quotes and newlines.

    The label is found by its header name, so a file may order its columns as it likes; an unlabelled
    table has a null ``Category``. A cell that is not of its type raises. A multi-line file is read by one task: deliver a large corpus as
    many files, or without newlines in its fields and with ``multi_line=False``.
    """
    names = _csv(spark, path, None, multi_line).columns
    types = {"Id": "bigint", "Category": "int" if labelled else "string"}
    df = _csv(spark, path, ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names), multi_line)
    category = F.col("Category") if labelled else F.lit(None).cast("int").alias("Category")
    return df.select("Id", category, "text")


def _sorted_out(read: DataFrame, broken: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects (file, line)) of a permissive read; written, since the columns decide together which lines are broken."""
    both = materialize(read.withColumn("_file", F.col("_metadata.file_path")), "read")
    rejects = both.where(F.col(broken).isNotNull()).select(F.col("_file").alias("file"), F.col(broken).alias("line"))
    if (n := rejects.count()) > limit:
        raise ValueError(f"{n} broken lines, more than the limit of {limit}")
    return both.where(F.col(broken).isNull()).drop(broken, "_file"), rejects


def read_reviews_or_reject(spark: SparkSession, path: str, limit: int, labelled: bool = True, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 in two: (reviews as :func:`read_reviews` gives them, rejects (file, line)). More rejects than ``limit`` raise."""
    names = _csv(spark, path, None, multi_line).columns
    types = {"Id": "bigint", "Category": "int" if labelled else "string"}
    schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names) + ", `_broken` string"
    options = dict(header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
    good, rejects = _sorted_out(spark.read.csv(path, schema=schema, **options), "_broken", limit)
    category = F.col("Category") if labelled else F.lit(None).cast("int").alias("Category")
    return good.select("Id", category, "text"), rejects


def read_articles_or_reject(spark: SparkSession, path: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """S2 in two: (articles as :func:`read_articles` gives them, rejects (file, line)). More rejects than ``limit`` raise."""
    read = spark.read.schema(f"{ARTICLE_SCHEMA}, _broken string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
    return _sorted_out(read, "_broken", limit)


def write_reviews(df: DataFrame, path: str) -> None:
    """The CSV form that :func:`read_reviews` reads."""
    df.select("Id", "Category", "text").write.csv(path, header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """(id, maintext, title) from JSON Lines; the title is null where a record has none. A broken line raises."""
    return spark.read.schema(ARTICLE_SCHEMA).json(path, mode="FAILFAST")


def write_articles(df: DataFrame, path: str) -> None:
    df.select("id", "maintext", "title").write.json(path)


def write_answers(df: DataFrame, path: str, label: str = "pred") -> None:
    """S3: ``Id,Category`` with a header."""
    df.select("Id", F.col(label).alias("Category")).write.csv(path, header=True)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="Id bigint, Category int", header=True, mode="FAILFAST")


def write_titles(df: DataFrame, path: str) -> None:
    """``{"title", "id"}`` per line, Unicode as it is; each partition writes its own file."""
    df.select(or_placeholder(F.col("title")).alias("title"), F.col("id").cast("bigint").alias("id")).write.json(path)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("title string, id bigint").json(path, mode="FAILFAST")
