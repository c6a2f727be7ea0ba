"""Language identification by n-gram Bloom filters that hold a bit for each language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import mixed, texts_of, write_once

SIZES = (3, 4)
#: An n-gram is one of a language if it makes up this part of it, and of its own kind this part of what it makes up in any.
MIN_RATE, MIN_SHARE, MIN_COUNT = 1e-5, 0.2, 2
HASHES, SLOTS_PER_NGRAM = 4, 16
CHARS = 1 << 18
WORDS = 1 << 18


class Model(NamedTuple):
    languages: list[str]
    filters: list[np.ndarray]
    false_rates: np.ndarray
    fallback: int


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _ngrams(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first positions, 64-bit keys) of the n-grams within words, one blank (0) at either end included."""
    wide = chars.astype(np.uint64)
    for n in SIZES:
        if len(chars) < n:
            continue
        span = len(chars) - n + 1
        inside = np.ones(span, bool)
        for k in range(1, n - 1):
            inside &= chars[k : k + span] != 0
        at = np.flatnonzero(inside)
        keys = np.full(len(at), n, np.uint64)
        for k in range(n):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + wide[at + k] + np.uint64(1)
        yield at, mixed(keys)


def _chars(text: str) -> np.ndarray:
    """Lower-case letters as code points, anything else as 0, with a 0 at either end."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[codes], codes, 0)


def _counted(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some words, and how often each occurs."""
    chars = _chars(" ".join(words))
    raw = " ".join(words).lower()
    blanks = np.frombuffer(f" {raw} ".encode("utf-32-le", "surrogatepass"), np.uint32) == 32
    times = np.array([*words.values(), 0], np.int64)
    weight = times[np.minimum(np.cumsum(blanks) - 1, len(words))]
    keys, counts = [], []
    for at, key in _ngrams(chars):
        keys.append(key)
        counts.append(weight[at + 1])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, n) of a part of the corpus, summed per distinct word first."""
    words: dict[str, Counter] = {}

    def flush(lang: str) -> pa.RecordBatch:
        keys, n = _counted(words.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(1), texts_of(batch), strict=True):
            lang = lang.as_py()
            words.setdefault(lang, Counter()).update(text.as_py().lower().split())
            if sum(map(len, words.values())) > WORDS:
                for full in list(words):
                    yield flush(full)
    for lang in list(words):
        yield flush(lang)


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learn which n-grams each language of ``docs`` has; null languages and texts are left out.

    Counts cover all the given documents. A language holds an n-gram if it makes up at least ``MIN_RATE`` of its n-grams, so
    it has at most 1 / MIN_RATE of them, which bounds what comes to the driver. The rate must also be ``MIN_SHARE`` of the n-gram's highest in
    any language, which keeps out words quoted from others. No documents: a model without languages.
    """
    train = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counts = train.mapInArrow(_count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    counts = write_once(counts, "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    likely = rates.where((F.col("rate") >= MIN_RATE) & (F.col("n") >= MIN_COUNT))
    best = likely.groupBy("key").agg(F.max("rate").alias("best"))
    held = likely.join(best, "key").where(F.col("rate") >= MIN_SHARE * F.col("best")).select("lang", "key").toArrow()
    languages = sorted((r.lang, r.total) for r in totals.collect())
    index = {name: i for i, (name, _) in enumerate(languages)}
    keys, of = held["key"].to_numpy().view(np.uint64), np.array([index[x] for x in held["lang"].to_pylist()], np.int64)
    slots = 1 << max(10, int(len(np.unique(keys)) * SLOTS_PER_NGRAM).bit_length())
    filters, filled = [], np.zeros(len(languages))
    for low in range(0, len(languages), 8):
        rows = np.zeros(slots, np.uint8)
        for bit in range(min(8, len(languages) - low)):
            own = keys[of == low + bit]
            for place in _places(own, slots):
                rows[place] |= np.uint8(1 << bit)
            filled[low + bit] = np.mean(rows >> np.uint8(bit) & 1)
        filters.append(rows)
    fallback = max(range(len(languages)), key=lambda i: (languages[i][1], -i), default=0)
    return Model([name for name, _ in languages], filters, filled**HASHES, fallback)


def _places(keys: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """The rows of the filter that hold a key."""
    step = mixed(keys + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
    for k in range(HASHES):
        yield ((keys + np.uint64(k) * step) & np.uint64(slots - 1)).astype(np.int64)


def _hits(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: n-grams that each language holds, n-grams in all, and whether it has a letter."""
    parts = [_chars(t) for t in texts]
    chars, starts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
    hits, total = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for at, keys in _ngrams(chars):
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + 1 < starts[text + 1]  # not the blanks where two texts meet
        keys, text = keys[inside], text[inside]
        total += np.bincount(text, minlength=len(texts))
        for group, rows in enumerate(model.filters):
            held = None
            for place in _places(keys, len(rows)):
                held = rows[place] if held is None else held & rows[place]
            # A row of the filter is a byte, so the counts of all its 256 values give the counts of its bits.
            values = np.bincount(text * 256 + held, minlength=len(texts) * 256).reshape(-1, 256)
            for bit in range(min(8, len(model.languages) - 8 * group)):
                hits[:, 8 * group + bit] += values[:, np.arange(256) >> bit & 1 == 1].sum(axis=1)
    letters = np.array([bool((p != 0).any()) for p in parts])
    return hits, total, letters


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for each whole text.

    The language whose filter holds most of the n-grams, after taking off what a filter so full says by mistake; the score is its part
    of the sum over the languages. Ties go to the first by name. Null and texts without a letter are ``und`` with score 0, and so is any
    text if no language was learned. A text of which no language holds an n-gram gets the most frequent language, score 0.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "_text").to_pylist()
            names: list[str] = []
            scores: list[float] = []
            start = 0
            while start < len(texts):
                stop, size = start + 1, len(texts[start])
                while stop < len(texts) and size + len(texts[stop]) <= CHARS and stop - start < 1024:
                    size += len(texts[stop])
                    stop += 1
                hits, total, letters = _hits(texts[start:stop], model)
                wrong = total[:, None] * model.false_rates
                true = np.maximum(0, (hits - wrong) / np.maximum(1e-9, 1 - model.false_rates))
                for row, letter in zip(true, letters, strict=True):
                    known = row.sum() > 0 if len(row) else False
                    best = int(row.argmax()) if known else model.fallback
                    names.append(model.languages[best] if letter and model.languages else "und")
                    scores.append(float(row[best] / row.sum()) if letter and known else 0.0)
                start = stop
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], schema.names)

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
