"""Near-duplicate vectors by iterative quantisation, multi-index Hamming tables and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import gathered, write_once
from lexmill.llm.components import components
from lexmill.llm.hamming import labels
from lexmill.llm.meeting import COLUMNS, KEYS, first_table, met_rows, signed, sorted_groups
from lexmill.llm.tiles import tiles
from lexmill.llm.vectors import matrix, sample, unit, usable
from lexmill.operators.scale import lookup_join
from lexmill.runtime import shuffle_partitions

COSINE = 0.95
SAMPLE, ROUNDS, MAX_BITS = 20_000, 30, 64
#: Bits of the long code, which rules out what the short codes let through.
LONG = 128
#: Vectors of a bucket that are compared at once; of codes, which are smaller, ``CODES`` times as many.
TILE, CODES = 1 << 14, 16
VECTOR_ROWS = 1 << 16
#: Two hashes of a vector, which stand for it where vectors are told apart.
SAME = ["h1", "h2"]
MISSED, PAIRS = 1e-4, 40_000
#: Comparisons in the buckets of parts, as a multiple of those of all codes, above which one bucket has them all.
CROWDED = 8.0


class Coder(NamedTuple):
    mean: np.ndarray
    turn: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A sign for each direction, as the bits of a number."""
        x = unit(x)
        bits = np.zeros((len(x), MAX_BITS), np.uint8)
        bits[:, : self.turn.shape[1]] = (x - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()

    def long(self, x: np.ndarray) -> np.ndarray:
        """A sign for each of ``LONG`` random directions, as the bits of two numbers a row."""
        turn = np.random.default_rng(5).normal(size=(len(self.mean), LONG))
        return np.packbits((unit(x) - self.mean) @ turn > 0, axis=1, bitorder="little").view(np.int64)


def fit(x: np.ndarray, seed: int = 2) -> Coder:
    """Main directions of the unit vectors, turned so that signs lose least: alternate between signs and the rotation."""
    x = unit(x)
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd((x - mean).T @ (x - mean))
    bits = min(MAX_BITS, x.shape[1])
    main = axes[:bits].T
    y = (x - mean) @ main
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(ROUNDS):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    return Coder(mean, main @ turn)


def _parts(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, mask) of the parts of a code."""
    ends = [bits * i // parts for i in range(parts + 1)]
    return [(a, ((1 << (b - a)) - 1) << a) for a, b in zip(ends, ends[1:], strict=False)]


def _at_threshold(x: np.ndarray, cosine: float, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """``PAIRS`` pairs of unit vectors of this cosine, half moved in any direction, half towards another vector of the sample."""
    rng = np.random.default_rng(seed)
    x = unit(x)
    u = x[rng.integers(0, len(x), PAIRS)]
    w = rng.normal(size=u.shape)
    w[::2] = x[rng.integers(0, len(x), len(w[::2]))] - u[::2] + w[::2] * 1e-6
    w -= np.sum(w * u, axis=1, keepdims=True) * u
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)
    return u, cosine * u + math.sqrt(1 - cosine * cosine) * w


def _plan(x: np.ndarray, coder: Coder, cosine: float) -> tuple[int, list[tuple[int, int]]]:
    """(radius, parts): how far apart codes of links may be, and the fewest parts of which they differ in at most one bit of some.

    Both are measured on pairs at the threshold made from the sample ``x``, so a common direction of the vectors, which the
    codes leave out, widens them; at most one pair in ten thousand is missed. The number of vectors has no part in
    it: buckets grow with the table and are compared in tiles. Where parts would be so short that their buckets
    hold more rows than the table, one bucket has all codes.
    """
    u, v = _at_threshold(x, cosine)
    differ = (coder.codes(u) ^ coder.codes(v)).view(np.uint64)
    apart, bits = np.bitwise_count(differ).astype(np.int64), coder.turn.shape[1]
    radius = min(bits, max(int(apart.max()), math.ceil(apart.mean() + 4 * apart.std())))
    for parts in range(1, bits + 1):
        cuts, width = _parts(bits, parts), bits / parts
        if parts * (1 + width) ** 2 / 2**width > CROWDED:
            break
        met = np.any([np.bitwise_count(differ & np.uint64(mask)) <= 1 for _, mask in cuts], axis=0)
        if np.count_nonzero(~met) <= MISSED * PAIRS:
            return radius, cuts
    return radius, [(0, 0)]


def _long_radius(x: np.ndarray, coder: Coder, cosine: float) -> int:
    """How far apart long codes of links may be, measured as the radius of :func:`_plan`."""
    u, v = _at_threshold(x, cosine)
    apart = np.bitwise_count((coder.long(u) ^ coder.long(v)).view(np.uint64)).sum(axis=1, dtype=np.int64)
    return min(LONG, max(int(apart.max()), math.ceil(apart.mean() + 4 * apart.std())))


def _block_bits(n: int, cuts: list[tuple[int, int]], partitions: int) -> int:
    """The first bits of a part by which ``n`` codes are dealt out: the fewest that give each task a share of a table, within the bound of a tile."""
    most = min(CODES * TILE, max(1 << 12, n * len(cuts) // partitions))
    bits, narrowest = 0, min(mask.bit_count() for _, mask in cuts)
    while bits < narrowest and n * (1 + bits / 2) > most << bits:
        bits += 1
    return bits


def _rerank(cosine: float, width: int, masks: list[int]):
    """Exact cosines of the rows of each group: links per row (kind 0), and a forest (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = gathered(batches, RERANK)
        if rows.num_rows == 0:
            return
        order, group = sorted_groups(rows)
        bucket, code, t, node, own, tile, weight = (rows[c].to_numpy()[order] for c in ("bucket", "code", "t", "node", "own", "tile", "weight"))
        home = code & np.array([signed(m) for m in masks])[t] == bucket
        x = unit(matrix(rows["v"], width)[order])
        edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        for all_of in np.split(np.arange(len(order)), edges[1:]):
            hosts, links, pairs = all_of[home[all_of]], np.zeros(len(all_of), np.int64), []
            split = tile[all_of[0]] >> 31 != tile[all_of[0]] & ((1 << 31) - 1)  # two chunks: pairs within one are counted elsewhere
            for i in range(0, len(hosts), 256):
                h = hosts[i : i + 256]
                r, c = np.nonzero(x[h] @ x[all_of].T >= cosine - 1e-9)
                a, b = h[r], all_of[c]
                good = (np.einsum("ij,ij->i", x[a], x[b]) >= cosine) & (node[a] != node[b]) & (first_table(code[a], code[b], masks, 1) == t[a])
                if split:
                    good &= own[a] != own[b]
                a, b, c = a[good], b[good], c[good]
                # Two hosts find each other from either side, a host and a visitor only from the host's.
                links += np.bincount(c, weight[a], minlength=len(all_of)).astype(np.int64)
                links += np.bincount(np.searchsorted(all_of, a), weight[b] * ~home[b], minlength=len(all_of)).astype(np.int64)
                pairs.append((np.searchsorted(all_of, np.maximum(a, b)), np.searchsorted(all_of, np.minimum(a, b))))
            label = labels(len(all_of), iter(pairs))
            linked, moved = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(all_of)))
            u = np.concatenate([node[all_of[linked]], node[all_of[moved]]])
            v = np.concatenate([links[linked], node[all_of[label[moved]]]])
            kind = np.concatenate([np.zeros(len(linked), np.int32), np.ones(len(moved), np.int32)])
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(u), pa.array(v)], ["kind", "u", "v"])

    return run


RERANK = pa.schema([*KEYS, ("weight", pa.int64()), ("v", pa.list_(pa.float64()))])


def _classes(vectors: DataFrame, width: int, coder: Coder) -> DataFrame:
    """(h1, h2, node, weight, code, long_a, long_b): distinct vectors with their smallest key and number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(3), width)
            a, b = coder.long(x).T
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(coder.codes(x)), pa.array(a.copy()), pa.array(b.copy())], ["id", *SAME, "code", "long_a", "long_b"])

    coded = vectors.select("id", *SAME, "v").mapInArrow(run, "id bigint, h1 bigint, h2 bigint, code bigint, long_a bigint, long_b bigint")
    distinct = coded.groupBy(*SAME).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"), *[F.min(c).alias(c) for c in ("code", "long_a", "long_b")])
    return distinct.where(F.col("node").isNotNull())


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) for each row: rows linked directly, and the smallest key reachable by links.

    Equal vectors, told by two hashes of 64 bits, are one node of the search and count with all their rows. Codes that differ in at
    most one bit of some part meet: a table deals them out by the first bits of its part, and a code also goes where one of these
    that it has set is not. Only codes are dealt out, a short one by which they meet and a long one that rules most of
    the others out; this gives rows and not pairs, and then the vectors of those rows only move. Groups of any size are
    compared in tiles. A pair counts in the first table where it meets. The rotation is learned from at most ``SAMPLE`` distinct vectors, which
    also say how far apart the codes of links may be and how many parts find them.

    Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing, equal ones included. Vectors of
    different lengths never link; each length is a search of its own, one after the other. Rows that repeat a key are rows of their own. A row with a null key has its links; its component
    is the smallest key that it reaches, or null.
    """
    # Floats stay floats, which take half the room; they are compared as doubles.
    kind = "float" if vectors.schema[vector].dataType == T.ArrayType(T.FloatType()) else "double"
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(f"`{vector}`").cast(f"array<{kind}>").alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x)))
    good = usable("v")
    widths = sorted(r[0] for r in rows.where(good).select(F.size("v")).distinct().collect())
    found = rows.where(~good).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    for width in widths:
        found = found.union(_of_width(rows.where(good & (F.size("v") == width)), width, cosine))
    return found.withColumnRenamed("id", key)


def _of_width(good: DataFrame, width: int, cosine: float) -> DataFrame:
    """(id, n_links, component_id, kept) of the rows (id, v), whose vectors all have the length ``width``."""
    good = good.withColumns({h: F.xxhash64(F.lit(i), "v") for i, h in enumerate(SAME)})
    first = good.groupBy(*SAME).agg(F.min("id").alias("id"))
    picked = write_once(first.orderBy(F.xxhash64(F.lit(4), "id"), "id").limit(SAMPLE), "distinct-vectors")
    learned = sample(good.drop("id").join(F.broadcast(picked), SAME).dropDuplicates(SAME), "id", "v", width, SAMPLE, "double")
    coder = fit(learned)
    (radius, cuts), long_radius = _plan(learned, coder, cosine), _long_radius(learned, coder, cosine)
    classes = write_once(_classes(good, width, coder), "classes")
    met = _met(classes, radius, long_radius, cuts)
    known = write_once(met.select("node", "code").distinct().join(classes, ["node", "code"]).select(*SAME, "node", "code", "weight"), "met-classes")
    held = lookup_join(good.select(*SAME, "v"), known, SAME).groupBy(*SAME, "node", "code", "weight").agg(F.first("v").alias("v"))
    tasks = max(shuffle_partitions(good.sparkSession), -(-met.count() // VECTOR_ROWS))
    full = tiles(met, TILE).join(held.drop(*SAME), ["node", "code"]).select(*COLUMNS, "weight", "v").repartition(tasks, "t", "bucket", "tile")
    found = write_once(full.mapInArrow(_rerank(cosine, width, [mask for _, mask in cuts]), "kind int, u bigint, v bigint"), "links")
    linked = found.where(F.col("kind") == 0).groupBy(F.col("u").alias("node")).agg(F.sum("v").alias("others"))
    reached = components(found.where(F.col("kind") == 1).select("u", "v"))
    groups = classes.select("node", "weight", *SAME).join(linked, "node", "left").join(reached, "node", "left")
    groups = write_once(groups.select(*SAME, (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")), "groups")
    done = good.select("id", *SAME).join(groups, SAME, "left")
    component = F.coalesce("component_id", "id")
    return done.select("id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def _met(classes: DataFrame, radius: int, long_radius: int, cuts: list[tuple[int, int]]) -> DataFrame:
    """(t, bucket, node, code) of the ``classes`` that meet another there for the first time, each once; written."""
    n, code, places = classes.count(), F.col("code"), []
    first = _block_bits(n, cuts, shuffle_partitions(classes.sparkSession))
    for t, (start, _) in enumerate(cuts):
        bits = [1 << b for b in range(start, start + first)]
        own = code.bitwiseAND(F.lit(signed(sum(bits))))
        places.append(F.struct(F.lit(t).alias("t"), own.alias("bucket")))
        # Only where the bit is not set, so that two codes meet once.
        places += [F.when(code.bitwiseAND(F.lit(signed(b))) != 0, F.struct(F.lit(t).alias("t"), own.bitwiseXOR(F.lit(signed(b))).alias("bucket"))) for b in bits]
    dealt = classes.select("node", "code", "long_a", "long_b", F.explode(F.array_compact(F.array(*places))).alias("x"))
    dealt = dealt.select("x.t", "x.bucket", "node", "code", "long_a", "long_b")
    count = int(n * len(cuts) * (1 + first / 2))
    return write_once(met_rows(dealt, count, radius, long_radius, [mask for _, mask in cuts], first, CODES * TILE).distinct(), "met")
