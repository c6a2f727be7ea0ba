"""The corpus pipeline: quality, near-duplicates, repeated passages, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import bpe, mixing, quality, simhash, substring
from lexmill.runtime import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, learned from ``labels``, does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep(docs, model)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (three-word shingles, 3 of 64 bits): that of smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 20 words or more that stand earlier; a text without such stays as it is."""
    return substring.cut(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_sha256, decoded_sha256) of each document of the mix."""
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    keyed = docs.select(F.struct("doc_id", "source").alias("key"), "text")
    return bpe.digests(keyed, vocabulary, "key").select("key.*", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality classifier", good_quality), ("SimHash near-dedup", near_distinct), ("substring dedup", without_repeats), ("mixing to target weights", mixed), ("byte-level BPE", tokens)]

#: SQL has neither the learned scores nor the hashes; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of ``documents`` after all stages, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
