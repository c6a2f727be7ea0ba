"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm import alignment, ann, bpe, embed_dedup, langid, licenses, lines, mixing, periodic, quality, quotes, simhash, substring
from lexmill.llm.common import WORD, crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Further queries of operators that have one.
VARIANTS: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def held_out(mod: int, rest: int):
    return F.coalesce(crc_mod("doc_id", mod) == rest, F.lit(False)).alias("held_out")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and the group that it belongs to."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicates of every vector."""
    return embed_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(crc_mod("doc_id", 3) != 1))
    return langid.predict(docs, model).select("doc_id", held_out(3, 1), "lang_pred", "score")


@query
def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op5_substring(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the passages that stand earlier."""
    left = substring.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Every message without quotes, with what it replies to and its place."""
    return quotes.link_quotes(table(spark, folder, "conversations"))


def op6_quotes_replies(spark: SparkSession, folder: str) -> DataFrame:
    """As op6_quotes, where of three turns one quotes the whole turn before, one the middle of its words."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = table(spark, folder, "conversations").withColumn("last", F.lag("text").over(order))
    turns = turns.withColumn("w", F.split(F.regexp_replace(F.trim("last"), r"\s+", " "), " "))
    quarter = F.floor(F.size("w") / 4).cast("int")
    whole = F.concat(F.regexp_replace(F.concat(F.lit("> "), F.col("last")), "\r\n?|\n", "\n> "), F.lit("\n"), F.col("text"))
    middle = F.concat(F.lit("> "), F.array_join(F.slice("w", 1 + quarter, F.size("w") - 2 * quarter), " "), F.lit(" ...\n"), F.col("text"))
    plain = F.col("last").isNull() | F.col("text").isNull() | (F.col("turn") % 3 == 0)
    text = F.when(plain, F.col("text")).when(F.col("turn") % 3 == 1, whole).otherwise(middle)
    return quotes.link_quotes(turns.withColumn("text", text).drop("last", "w"))


VARIANTS["op6_quotes_replies"] = op6_quotes_replies


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and their round trip."""
    import public_tokenizers

    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(table(spark, folder, "documents"), vocabulary)


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """The licence of every document, as a file of its language's folder in its source's folder; without doc_id it has no path."""
    docs = table(spark, folder, "documents")
    paths = F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    found = licenses.scan(docs.select(paths.alias("path"), "text"))
    return found.select(F.substring_index("path", "/", -1).cast("bigint").alias("doc_id"), "path", "licence", "how", "cosine", "folder")


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select("doc_id", held_out(4, 2), "score", "predicted")


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    taken = mixing.copies(table(spark, folder, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten, by the crc32 of its key, repeats some of its words to its end, as the query's contract has it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    chosen = chosen.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.transform(F.sequence("a", (F.col("n") - 1).cast("bigint")), place))
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of every text, the strongest of them, and the text without what they repeat."""
    found = periodic.find_runs(planted(table(spark, folder, "documents").select("doc_id", "text")))

    def stronger(best, run):
        ahead = run["length"] * best["period"] - best["length"] * run["period"]
        tie = (run["start"] < best["start"]) | ((run["start"] == best["start"]) & (run["period"] < best["period"]))
        return F.when(best["period"].isNull() | (ahead > 0) | ((ahead == 0) & tie), run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), stronger)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the lines that many share."""
    left = lines.drop_common_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Where the tokens of two tokenizers end together in every text."""
    import public_tokenizers

    files = alignment.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    found = alignment.link(table(spark, folder, "documents").select("doc_id", "text"), files)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
