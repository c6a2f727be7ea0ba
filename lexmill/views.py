"""Reviews, articles and dialogue pairs out of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.hashing import unit_hash
from lexmill.runtime import spread

# Put into a review, so that every literal of T1 occurs.
REVIEW_MARK = " 好，>:<還是^^ 應我該"

# Put into an article, one by ``id % 18``, so that every rule of T4 fires; the last is no marker.
ARTICLE_MARKS = [
    "延伸閱讀 b\nc",
    "《原文刊登於x\ny",
    "來源：z\nw",
    "來源：文．k\nq",
    "p文．q",
    "看這裡>> u\nv",
    "看這裡>>\nv",
    "本文摘自 j\nl",
    "【a】b【c\nd】",
    "(a)b(c\nd)",
    "x\ny",
    "see http://a.b/c\nnext end",
    "圖／a提供b提供c",
    "圖／翻攝自臉書社團 z",
    "（a\nb）c",
    "《本文作者 a\nb",
    "地址：a\nb",
    "",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The given columns of the documents, on all cores."""
    return spread(table(spark, folder, "documents").select("doc_id", *columns), "doc_id")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """(Id, Category, text, split): unlabelled documents are the test split."""
    texts = documents(spark, folder, "text").withColumnRenamed("doc_id", "Id")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("Id"), F.col("quality").alias("Category"))
    split = F.when(F.col("Category").isNull(), "test").when(unit_hash(42, "Id") < 0.8, "train").otherwise("dev")
    return texts.join(labels, "Id", "left").select("Id", "Category", "text", split.alias("split"))


def reviews_marked(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews in which every second text holds the literals of T1."""
    marked = F.when(F.col("Id") % 2 == 0, F.concat("text", F.lit(REVIEW_MARK))).otherwise(F.col("text"))
    return reviews(spark, folder).withColumn("text", marked)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """(id, maintext, title): the first line of a document is its title."""
    cut = table(spark, folder, "documents").select("doc_id", "text", F.instr("text", "\n").alias("cut")).where(F.col("cut") > 1)
    parts = cut.select(
        F.col("doc_id").cast("string").alias("id"),
        F.expr("substring(text, cut + 1)").alias("maintext"),
        F.expr("substring(text, 1, cut - 1)").alias("title"),
    )
    # Cut first: a job that reads only the titles then moves only the titles.
    return spread(parts, "id")


def news_like(spark: SparkSession, folder: str) -> DataFrame:
    """Articles whose text ends with a marker of a cleaning rule."""
    marks = F.array(*map(F.lit, ARTICLE_MARKS))
    mark = F.get(marks, (F.col("id").cast("bigint") % len(ARTICLE_MARKS)).cast("int"))
    return articles(spark, folder).withColumn("maintext", F.concat("maintext", mark))


def dialog_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, source_text, target_text): a user turn and the assistant's answer to it."""
    turns = spread(table(spark, folder, "conversations"), "conv_id")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source_text"))
    answered = turns.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target_text"))
    return asked.join(answered, ["conv_id", "turn"])
