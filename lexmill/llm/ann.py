"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import gathered, write_once
from lexmill.llm.vectors import matrix, of_one_width, sample
from lexmill.runtime import shuffle_partitions

SAMPLE, NEIGHBOURS, PARTS, MOST_PARTS = 12_288, 10, 64, 1024
HIDDEN, EPOCHS, BATCH, RATE = 128, 12, 256, 2e-3
RECALL = 0.96
VECTORS, QUERIES = 4096, 2048
TASK_ROWS = 1 << 16


class Router(NamedTuple):
    mean: np.ndarray
    scale: float
    first: np.ndarray
    offset: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0, (x - self.mean) * self.scale @ self.first + self.offset)
        return hidden @ self.second + self.bias


def _top(x: np.ndarray, base: np.ndarray, k: int, own: bool) -> np.ndarray:
    """The k rows of ``base`` of largest inner product for each row of ``x``, nearest first."""
    found = []
    for i in range(0, len(x), 512):
        g = x[i : i + 512] @ base.T
        if own:
            g[np.arange(len(g)), np.arange(i, i + len(g))] = -np.inf
        near = np.argpartition(-g, k - 1, axis=1)[:, :k]
        found.append(np.take_along_axis(near, np.argsort(-np.take_along_axis(g, near, 1), axis=1), 1))
    return np.concatenate(found)


def _partition(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of about equal size with many edges of the graph inside.

    From random centres, each round gives a row the part that holds most of its neighbours (then the nearest
    centre), rows of the clearest preference first, as long as the part has room.
    """
    n, room = len(x), int(np.ceil(1.05 * len(x) / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    part = np.full(n, -1)
    for _ in range(10):
        liking = x @ (centre / np.maximum(1e-12, np.linalg.norm(centre, axis=1, keepdims=True))).T
        liking /= np.abs(liking).max() + 1e-12
        if part[0] >= 0:
            for k in range(near.shape[1]):
                np.add.at(liking, (np.arange(n), part[near[:, k]]), 1.0)
        best = np.sort(liking, axis=1)[:, -2:]
        choice, left = np.argsort(-liking, axis=1), np.full(parts, room)
        new = np.empty(n, np.int64)
        for i in np.argsort(best[:, 0] - best[:, 1], kind="stable"):
            for p in choice[i]:
                if left[p]:
                    new[i], left[p] = p, left[p] - 1
                    break
        part = new
        centre = np.stack([x[part == p].mean(axis=0) if (part == p).any() else centre[p] for p in range(parts)])
    return part


def _route(x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator) -> Router:
    """A network of one hidden layer from a vector to the parts where its neighbours are (Adam, cross-entropy)."""
    mean, scale = x.mean(axis=0), 1 / max(1e-12, float(x.std()))
    weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, wanted.shape[1])), np.zeros(wanted.shape[1])]
    one, two, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    z = (x - mean) * scale
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for i in range(0, len(z), BATCH):
            own = order[i : i + BATCH]
            hidden = np.maximum(0, z[own] @ weights[0] + weights[1])
            out = hidden @ weights[2] + weights[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - wanted[own]) / len(own)
            back = error @ weights[2].T * (hidden > 0)
            step += 1
            for k, g in enumerate((z[own].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                weights[k] = weights[k] - RATE * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *weights, 1)


def fit(x: np.ndarray, parts: int, k: int, recall: float = RECALL, seed: int = 4) -> Router:
    """Learn parts and a router from a sample; the probes are as many as reach ``recall`` within the sample.

    A tenth of the sample is kept out of the training of the router, to count the probes by.
    """
    rng = np.random.default_rng(seed)
    parts = max(1, min(parts, len(x) // 8))
    if parts == 1:
        return Router(np.zeros(x.shape[1]), 1.0, np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    near = _top(x, x, min(max(k, NEIGHBOURS), len(x) - 1), True)
    part = _partition(x, near[:, :NEIGHBOURS], parts, rng)
    wanted = np.zeros((len(x), parts))
    for column in near.T:
        np.add.at(wanted, (np.arange(len(x)), part[column]), 1 / near.shape[1])
    np.add.at(wanted, (np.arange(len(x)), part), 1.0)
    wanted /= wanted.sum(axis=1, keepdims=True)
    tested = rng.permutation(len(x))[: min(1024, len(x) // 10 + 1)]
    learned = np.setdiff1d(np.arange(len(x)), tested)
    router = _route(x[learned], wanted[learned], rng)
    placed = router.logits(x).argmax(axis=1)
    order = np.argsort(-router.logits(x[tested]), axis=1)
    rank = np.argsort(order, axis=1)
    needed = np.take_along_axis(rank, placed[near[tested][:, :k]], 1)
    reached = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    return router._replace(probes=int(np.searchsorted(reached, recall)) + 1)


def _search(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = gathered(batches, SCHEMA)
        if rows.num_rows == 0:
            return
        tile, ids, query = rows["tile"].to_numpy(), rows["id"].to_numpy(), rows["query"].to_numpy()
        x = matrix(rows["v"], width)
        order = np.lexsort((ids, query, tile))
        edges = np.flatnonzero(np.append(True, tile[order][1:] != tile[order][:-1]))
        for own in np.split(order, edges[1:]):
            asked, base = own[query[own]], own[~query[own]]
            for i in range(0, len(asked) if len(base) else 0, 256):
                q = asked[i : i + 256]
                g = x[q] @ x[base].T
                g[ids[q][:, None] == ids[base][None, :]] = -np.inf
                m = min(k, len(base))
                least = -np.partition(-g, m - 1, axis=1)[:, m - 1]
                # All that rounding may have put below the k-th are looked at again, summed in one fixed order.
                r, c = np.nonzero((g >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & np.isfinite(g))
                score = np.einsum("ij,ij->i", x[q[r]], x[base[c]])
                best = np.lexsort((ids[base[c]], -score, r))
                r, c, score = r[best], c[best], score[best]
                first = np.searchsorted(r, r)
                top = np.arange(len(r)) - first < k
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[r[top]]]), pa.array(ids[base[c[top]]]), pa.array(score[top])], ["query_id", "vec_id", "score"])

    return run


SCHEMA = pa.schema([("tile", pa.int64()), ("id", pa.int64()), ("query", pa.bool_()), ("v", pa.list_(pa.float64()))])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` of largest inner product found for each row of ``queries``.

    Both hold (key, vector). The router learns from at most ``SAMPLE`` vectors; every vector is in the index, in its likeliest part, and
    a query goes to its ``probes`` likeliest. A part meets its queries in tiles of about ``VECTORS`` by ``QUERIES`` rows, so a part of any size is many
    tasks, and a tile gives k rows per query. The score is the inner product in double precision of the given vectors, ties go to the smaller key. A
    query never finds rows of its own key; fewer than k candidates give fewer rows. Vectors that are null, empty, zero,
    hold null or non-finite numbers or are not of the most frequent length take no part, nor do rows with a null key. Repeated rows are
    candidates of their own.
    """
    both = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull())
    base, width = of_one_width(both, "v")
    asked = queries.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull())
    spark = vectors.sparkSession
    if width == 0:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = of_one_width(asked, "v")[0].where(F.size("v") == width).dropDuplicates(["id"])
    base = write_once(base, "vectors")
    n = base.count()
    router = fit(sample(base, "id", "v", width, SAMPLE), min(MOST_PARTS, max(PARTS, int(n**0.5 / 8))), k, recall)

    def routed(probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best = np.argsort(-router.logits(matrix(batch.column(1), width)), axis=1, kind="stable")[:, :probes].astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, best.size + 1, best.shape[1], dtype=np.int32), best.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "v", "parts"])

        return run

    def parts_of(df: DataFrame, probes: int) -> DataFrame:
        found = df.mapInArrow(routed(probes), "id bigint, v array<double>, parts array<int>")
        return write_once(found.select("id", "v", F.explode("parts").alias("part")), "routed")

    base, asked = parts_of(base, 1), parts_of(asked, router.probes)
    held = dict(base.groupBy("part").count().collect())  # one row per part, so at most MOST_PARTS
    sent = dict(asked.groupBy("part").count().collect())
    chunks = {p: -(-c // VECTORS) for p, c in held.items()}
    blocks = {p: -(-sent.get(p, 0) // QUERIES) for p in held}

    def number(of: dict[int, int]):
        return F.get(F.array(*[F.lit(of.get(p, 0)) for p in range(len(router.bias))]), F.col("part"))

    chunk, block = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), number(chunks))).cast("bigint"), F.pmod(F.xxhash64(F.lit(1), "id"), F.greatest(F.lit(1), number(blocks))).cast("bigint")
    every = lambda of: F.explode(F.when(number(of) > 0, F.sequence(F.lit(0), number(of) - 1)))
    tile = F.col("part").cast("bigint") * (1 << 40) + F.col("chunk") * (1 << 20) + F.col("block")
    rows = base.withColumn("chunk", chunk).withColumn("block", every(blocks)).select(tile.alias("tile"), "id", F.lit(False).alias("query"), "v")
    more = asked.withColumn("block", block).withColumn("chunk", every(chunks)).select(tile.alias("tile"), "id", F.lit(True).alias("query"), "v")
    size = sum(c * blocks[p] + sent.get(p, 0) * chunks[p] for p, c in held.items())
    tasks = max(shuffle_partitions(spark), -(-size // TASK_ROWS))
    found = rows.union(more).repartition(tasks, "tile").mapInArrow(_search(k, width), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
