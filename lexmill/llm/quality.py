"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import byte_codes, crc_mod, mixed, pieces, segment_hashes, texts_of, write_once

BITS = 18
SHARD_DOCS = 4096
ROUNDS = 5
MAX_TRAIN_DOCS = 20_000
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def _classes() -> np.ndarray:
    """0 white space, 1 letter, digit or non-ASCII byte, 2 any other mark."""
    kind = np.full(256, 2, np.uint8)
    kind[128:] = 1
    kind[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
    kind[[32, *range(9, 14)]] = 0
    return kind


KIND = _classes()
UPPER = np.zeros(256, np.int64)
UPPER[65:91] = 1
FOLD = byte_codes()
FOLD[65:91] = FOLD[97:123]


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash slots of the word n-grams of some texts, the text of each, and its value.

    Words are runs of letters and digits, and runs of marks. A text has its lower-case words, its pairs of
    words (a word repeated at once is one and the same pair, whatever the word), and its pairs of word shapes. Each
    of the three kinds sums up to 1 in a text, so long and short texts weigh alike.
    """
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    kind = KIND[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    inner = starts[:-1]
    edge[inner[inner < len(data)]] = True
    at = np.flatnonzero(edge)
    hashes = segment_hashes(FOLD[data], at, len(data))
    upper = np.add.reduceat(UPPER[data], at)
    size = np.diff(np.append(at, len(data)))
    word = kind[at] > 0
    at, hashes, upper, size, mark = at[word], hashes[word], upper[word], size[word], kind[at[word]] == 2
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    text = np.searchsorted(starts, at, "right") - 1
    shape = np.where(upper == 0, 1, np.where((upper == 1) & (size > 1), 2, 3)).astype(np.uint64)
    shape = np.where(mark, hashes, shape)
    pair = text[1:] == text[:-1]
    twice = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    twice[hashes[:-1] == hashes[1:]] = np.uint64(0x1234567)
    shapes = mixed(shape[:-1] * np.uint64(5) + shape[1:] + np.uint64(1))
    keys = np.concatenate([hashes, mixed(twice[pair]), mixed(shapes[pair])])
    n = np.maximum(np.bincount(text, minlength=len(starts) - 1), 1)
    m = np.maximum(np.bincount(text[1:][pair], minlength=len(starts) - 1), 1)
    second = text[1:][pair]
    return (keys >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([text, second, second]), np.concatenate([1 / n[text], 1 / m[second], 1 / m[second]])


def _probability(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _following(z0: np.ndarray, n0: np.ndarray):
    """One pass of updates over a shard, in the order of its hashes; the state where it is not zero."""

    def run(shard: pa.Table) -> pa.Table:
        z, n = z0.copy(), n0.copy()
        shard = shard.sort_by([("place", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        texts, labels = shard["text"].fill_null("").cast(pa.string()).combine_chunks(), shard["label"].to_numpy()
        for first, last, data, starts in pieces(texts):
            slots, text, value = features(data, starts)
            order = np.argsort(text, kind="stable")
            cut = np.searchsorted(text[order], np.arange(last - first + 1))
            for i in range(last - first):
                own = order[cut[i] : cut[i + 1]]
                idx, place = np.unique(slots[own], return_inverse=True)
                x = np.append(np.bincount(place, value[own], len(idx)), 1.0)
                idx = np.append(idx, 1 << BITS)
                w = _weights(z[idx], n[idx])
                g = (_probability(w @ x) - labels[first + i]) * x
                grown = n[idx] + g * g
                z[idx] += g - (np.sqrt(grown) - np.sqrt(n[idx])) / ALPHA * w
                n[idx] = grown
        idx = np.flatnonzero(n)
        return pa.table({"slot": idx.astype(np.int32), "z": z[idx], "n": n[idx]})

    return run


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out, max_docs: int) -> DataFrame:
    """(text, label) of at most ``max_docs`` labelled documents outside ``held_out``, those first by a hash of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("double").alias("label"))
    ids = docs.select("doc_id").join(known, "doc_id").where(~held_out).dropDuplicates(["doc_id"])
    ids = write_once(ids.orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(max_docs), "training-ids")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = MAX_TRAIN_DOCS, mod: int = 4, left_out: int = 2) -> Model:
    """Fit on labelled documents whose crc32 of the id, modulo ``mod``, is not ``left_out``.

    At most ``max_docs`` documents, whole texts, are learned from: a bounded sample by a hash of the id. They are dealt over as few shards
    as hold them at ``SHARD_DOCS`` each on average; in each of ``ROUNDS`` rounds every shard updates from the common state and the states are averaged.
    A shard's state has at most 2^18 + 1 slots, the bound of what it sends to the driver. No labelled
    document gives the zero model, which scores 0.5.
    """
    train = sample(docs, labels, label, F.coalesce(crc_mod("doc_id", mod) == left_out, F.lit(True)), max_docs)
    shards = max(1, -(-train.count() // SHARD_DOCS))
    place = F.xxhash64(F.lit(2), "doc_id")
    train = write_once(train.select("doc_id", "text", "label", place.alias("place"), F.pmod(place, F.lit(shards)).alias("shard")), "training")
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(ROUNDS):
        got = train.groupBy("shard").applyInArrow(_following(z, n), "slot int, z double, n double").toArrow()
        slot = got["slot"].to_numpy()
        # A shard that has no row for a slot kept the common state; every shard has the bias.
        ran = np.bincount(slot, minlength=len(z))
        most = max(1, ran[-1])
        z, n = ((np.bincount(slot, got[c].to_numpy(), len(z)) + (most - ran) * old) / most for c, old in (("z", z), ("n", n)))
    w = _weights(z, n)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` (text among them) with score (0 to 1) and predicted (1 if score >= ``threshold``).

    Columns of these two names in ``docs`` are replaced.
    Null, empty and blank texts have no n-grams and get the model's bias.
    """
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.full(batch.num_rows, model.bias)
            for first, last, data, starts in pieces(texts_of(batch)):
                slots, text, value = features(data, starts)
                total[first:last] += np.bincount(text, model.weights[slots] * value, last - first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_probability(total))], schema.names)

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with its columns, that score ``threshold`` or more."""
    named = docs.withColumnsRenamed({c: f"{c}_" for c in docs.columns if c.rstrip("_") in ("score", "predicted")})
    good = score(named, model, threshold).where(F.col("predicted") == 1).drop("score", "predicted")
    return good.toDF(*docs.columns)
