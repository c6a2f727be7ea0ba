"""Line deduplication with built-in functions: common lines go, but in the last document that holds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once
from lexmill.operators.scale import lookup_join

LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """What makes lines equal: without blanks at both ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row(text: Column) -> Column:
    """Tells apart the rows of one doc_id. Rows of equal text lose the same lines."""
    return F.xxhash64(text)


def common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc_id, row, places): the lines that go, as ascending places counted from 0; written.

    Lines are told by two 64-bit hashes of their keys. Documents are counted from distinct (hash, doc_id), which
    are aggregated before and after they move, so a line in a third of all documents is spread over all tasks and reaches its
    last task as one row of each. The lines then look the common hashes up.
    """
    exploded = docs.where(F.col("doc_id").isNotNull()).select("doc_id", _row(F.col("text")).alias("row"), F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    keyed = exploded.select("doc_id", "row", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    lines = write_once(keyed.select("doc_id", "row", "place", F.xxhash64("key").alias("hash"), F.xxhash64(F.lit(1), "key").alias("check")), "lines")
    counted = lines.groupBy("hash", "check").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
    common = write_once(counted.where(F.col("n") >= least_documents).drop("n"), "common-lines")
    gone = lookup_join(lines, common, ["hash", "check"]).where(F.col("doc_id") < F.col("last"))
    return write_once(gone.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("place")).alias("places")), "gone-lines")


def drop_common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) with n_lines (before), n_dropped and kept, the other lines joined by line feeds.

    Whole texts are split at line feeds; a null or empty text is one empty line. Keys of 20 code points or more that stand in at
    least 3 documents lose all their lines except those in the document of largest doc_id. Rows that repeat a
    doc_id are one document in the counts, and each keeps its own lines. A row without a doc_id is no document: it counts
    nowhere and keeps all its lines. Columns of the three names in ``docs`` are replaced.

    Kept lines are the stretches between dropped places, so a text of many lines costs no more than its length.
    """
    docs = docs.drop("n_lines", "n_dropped", "kept")
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", _row(docs["text"]).alias("row"))
    found = lookup_join(left, common_lines(docs.select("doc_id", "text"), least_chars, least_documents), ["doc_id", "row"], "left")
    lines, n = _lines(F.col("doc.text")), F.size("places")
    # Place -1 and the number of lines are the ends of the first and the last stretch.
    ends = F.concat(F.array(F.lit(-1)), "places", F.array(F.col("n_lines").cast("int")))
    stretch = lambda i: F.slice("lines", F.element_at("ends", i) + 2, F.element_at("ends", i + 1) - F.element_at("ends", i) - 1)
    rest = F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), n + 1), stretch)), "\n")
    found = found.withColumn("lines", lines).withColumn("n_lines", F.size("lines").cast("bigint"))
    found = found.withColumn("ends", F.when(F.col("places").isNotNull(), ends))
    kept = F.when(F.col("places").isNotNull(), rest).otherwise(F.coalesce("doc.text", F.lit("")))
    return found.select("doc.*", "n_lines", F.coalesce(F.greatest(n, F.lit(0)), F.lit(0)).cast("bigint").alias("n_dropped"), kept.alias("kept"))
