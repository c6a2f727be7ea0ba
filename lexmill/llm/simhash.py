"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import frugal, gathered, texts_of, write_once
from lexmill.llm.components import components
from lexmill.llm.hamming import close, labels
from lexmill.llm.meeting import signed
from lexmill.llm.tiles import TILE, tiles
from lexmill.operators.scale import lookup_join
from lexmill.runtime import shuffle_partitions

WORDS, RADIUS, SEED = 3, 3, 42
BLOCKS = 5
TASK_ROWS = 1 << 20
CHUNK = 1 << 16


def _fingerprint(text: str, n: int) -> int:
    """Bit by bit the majority of the hashes of a text's n-word shingles; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < n:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
        total = len(words) - n + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, CHUNK):
        size = min(CHUNK, total - start)
        hashes = np.fromiter((xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(size)), np.uint64, size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fp): A-Z in lower case, shingles with repeats; fewer words: all of them; null or no words: 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_fingerprint(t.as_py(), words) for t in texts_of(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], [key, "fp"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(frugal(run), f"`{key}` {kind}, fp bigint")


def _masks(radius: int, blocks: int) -> list[int]:
    """Codes within the radius agree on at least one of these sets of bits: all blocks but ``radius`` of them."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    return [sum(block[i] for i in kept) for kept in combinations(range(blocks), blocks - radius)]


def _forest(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = gathered(batches, SCHEMA)
        t, bucket, node, code, tile = (c.to_numpy() for c in rows.columns)
        order = np.lexsort((node, tile, bucket, t))
        t, bucket, node, code, tile = t[order], bucket[order], node[order], code[order], tile[order]
        if len(t) == 0:
            return
        new = np.append(True, (t[1:] != t[:-1]) | (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1]))
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1
        node, code, group = node[many], code[many].view(np.uint64), group[many]
        label = labels(len(node), close(code, group, radius))
        moved = np.flatnonzero(label != np.arange(len(node)))
        yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["u", "v"])

    return run


SCHEMA = pa.schema([("t", pa.int32()), ("bucket", pa.int64()), ("node", pa.int64()), ("code", pa.int64()), ("tile", pa.int64())])


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect all ``nodes`` (node, code; codes distinct) within ``radius`` bits, directly or in steps.

    Codes that differ in at most ``radius`` of ``blocks`` blocks agree on the others, so each pair meets in a bucket of one of the
    tables. A task compares its buckets and gives a forest, one edge for a node at most, never the pairs.
    """
    masks = F.array(*[F.struct(F.lit(t).alias("t"), F.col("code").bitwiseAND(F.lit(signed(m))).alias("bucket")) for t, m in enumerate(_masks(radius, blocks))])
    rows = nodes.select("node", "code", F.explode(masks).alias("x")).select("x.t", "x.bucket", "node", "code")
    rows = tiles(rows, tile).drop("own")
    parts = max(shuffle_partitions(nodes.sparkSession), -(-nodes.count() * len(_masks(radius, blocks)) // TASK_ROWS))
    return rows.repartition(parts, "t", "bucket", "tile").mapInArrow(_forest(radius), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id) for each row: the smallest key reachable by fingerprints within ``radius`` bits.

    Equal fingerprints are one node, so copies cost nothing more. Null, empty and blank texts have fingerprint 0 and
    are linked like any other. Rows that repeat a key are rows of the result. Rows with a null key keep it, and count as a
    copy of the others: their component is the smallest other key, or null if there is none. Empty input gives no rows.
    """
    return _grouped(write_once(fingerprints(docs, key, text, words), "fingerprints"), key, radius)


def _grouped(fps: DataFrame, key: str, radius: int) -> DataFrame:
    """The written rows ``fps`` (key, fp and more) with the component_id of each."""
    nodes = write_once(fps.groupBy("fp").agg(F.min(key).alias("node")), "codes")
    edges = links(nodes.where(F.col("node").isNotNull()).select("node", F.col("fp").alias("code")), radius)
    found = components(edges)
    classes = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(write_once(classes, "classes"), "fp").select(*[c for c in fps.columns if c != "fp"], "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, whole, that are the smallest key of their group of :func:`near_duplicates`.

    Rows with a null key all stay. Rows of one key with different texts are judged apart; of those with equal texts one stays.
    Only rows that go, or that repeat, are looked up, so the documents move only if there are very many of them.
    """
    row = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("row"))
    fps = fingerprints(docs.select(row.alias("_key"), F.col(text).alias("_text")), "_key", "_text", words)
    found = _grouped(write_once(fps.select("_key.key", "_key.row", "fp"), "fingerprints"), "key", radius).where(F.col("key").isNotNull())
    judged = found.groupBy("key", "row").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    stays = F.col("key") == F.col("component_id")
    marks = write_once(judged.where(~stays | (F.col("n") > 1)).select(F.col("key").alias("_key"), F.col("row").alias("_row"), stays.alias("_stays")), "marks")
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(key).alias("_key"), F.xxhash64(text).alias("_row"))
    full = lookup_join(left, marks, ["_key", "_row"], "left")
    kept = full.where(F.col("_stays").isNull()).select("doc")
    if not marks.where("_stays").isEmpty():
        kept = kept.union(full.where("_stays").dropDuplicates(["_key", "_row"]).select("doc"))
    return kept.select("doc.*")
