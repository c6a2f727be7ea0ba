"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import frugal, offsets, texts_of

#: Pre-tokens of at most 64 bytes that a worker remembers in each of two generations: when the younger is full the older goes.
CACHE = 1 << 17
#: Bytes of text that a worker handles at once; one longer text is taken alone.
PART = 1 << 20
PER_BUCKET = 2


class Vocabulary(NamedTuple):
    name: str
    tokens: list[bytes]
    pattern: str
    seeds: np.ndarray
    slots: np.ndarray


def _hash(piece: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(piece, seed)


def _perfect(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A seed for each bucket so that every token falls on a slot of its own, and the id in each slot.

    The largest buckets come first. A seed below zero, for buckets of one token, names the slot itself.
    """
    n = len(tokens)
    buckets: list[list[int]] = [[] for _ in range(max(1, n // PER_BUCKET))]
    for i, token in enumerate(tokens):
        buckets[_hash(token, 0) % len(buckets)].append(i)
    seeds, slots, free = np.zeros(len(buckets), np.int64), np.full(n, -1, np.int64), None
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        own = buckets[b]
        if len(own) == 1:
            free = free if free is not None else iter(np.flatnonzero(slots < 0).tolist())
            place = next(free)
            seeds[b], slots[place] = -1 - place, own[0]
        elif own:
            seed = 1
            while True:
                places = [_hash(tokens[i], seed) % n for i in own]
                if len(set(places)) == len(own) and all(slots[p] < 0 for p in places):
                    break
                seed += 1
            seeds[b], slots[places] = seed, own
    return seeds, slots


def load(path: str, pattern: str) -> Vocabulary:
    """A vocabulary of ranks (base64 token and rank on each line) from a file of the driver; it is sent along with the job."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    tokens = [ranks[i] for i in range(len(ranks))]
    if len(set(tokens)) != len(tokens) or sum(len(t) == 1 for t in tokens) < 256:
        raise ValueError("a vocabulary holds each token once, and every byte")
    name = xxhash.xxh3_128_hexdigest(b"".join(tokens) + pattern.encode())
    return Vocabulary(name, tokens, pattern, *_perfect(tokens))


class Encoder(dict):
    """Pre-token to its ids; what is new is looked up or merged, and kept while there is room."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens, self.find = vocabulary.tokens, regex.compile(vocabulary.pattern).findall
        self.seeds, self.slots = vocabulary.seeds.tolist(), vocabulary.slots.tolist()
        self.ranks = {token: i for i, token in enumerate(vocabulary.tokens)}
        self.older: dict[str, tuple[int, ...]] = {}

    def lookup(self, piece: bytes) -> int:
        """The id of a whole token, or -1."""
        seed = self.seeds[_hash(piece, 0) % len(self.seeds)]
        at = self.slots[-1 - seed if seed < 0 else _hash(piece, seed) % len(self.slots)]
        return at if self.tokens[at] == piece else -1

    def merge(self, piece: bytes) -> list[int]:
        """Join the neighbours of lowest rank, leftmost first, until no joined pair is a token.

        ``after`` and ``before`` link the parts by their first bytes. ``rank`` has the rank of each part joined with the next; an
        entry of the heap (rank and place in one number) counts only if it still says so.
        """
        n, rank_of = len(piece), self.ranks.get
        shift = n.bit_length()
        none, low = 1 << 62, (1 << shift) - 1
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank = [rank_of(piece[i : i + 2], none) for i in range(n - 1)]
        rank.append(none)
        heap = [r << shift | i for i, r in enumerate(rank) if r != none]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i = top & low
            if rank[i] != top >> shift:
                continue
            j = after[i]
            stop = after[i] = after[j]
            rank[j] = rank[i] = none
            if stop < n:
                before[stop] = i
                rank[i] = r = rank_of(piece[i : after[stop]], none)
                if r != none:
                    heapq.heappush(heap, r << shift | i)
            h = before[i]
            if h >= 0:
                rank[h] = r = rank_of(piece[h:stop], none)
                if r != none:
                    heapq.heappush(heap, r << shift | h)
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return ids

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            whole = piece.encode()
            at = self.lookup(whole)
            ids = (at,) if at >= 0 else tuple(self.merge(whole))
            if len(whole) > 64:
                return ids
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.find(text))))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of some ids."""
        if ids and min(ids) < 0:
            raise ValueError("an id outside the vocabulary")
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except IndexError:
            raise ValueError("an id outside the vocabulary") from None


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if vocabulary.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.name] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.name]


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of rows of about PART bytes, or one longer row; ``sizes`` has where rows start and the last ends."""
    first = 0
    while first < len(sizes) - 1:
        last = min(len(sizes) - 1, max(first + 1, int(np.searchsorted(sizes, sizes[first] + PART, "right")) - 1))
        yield first, last
        first = last


def _lists(ids: list[list[int]]) -> pa.ListArray:
    return pa.array(ids, pa.list_(pa.int32()))


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each whole text, without special tokens. Null and empty text: no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            texts = texts_of(batch, "_text")
            for first, last in _parts(offsets(texts)):
                ids = [encoder.encode(t) for t in texts[first:last].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], _lists(ids)], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(frugal(run), f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the bytes of each list of ids. Null: no bytes; an unknown id raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in batches:
            for first, last in _parts(offsets(batch.column(1)) * 4):
                part = batch.column(1)[first:last]
                whole = [encoder.decode(i or []) for i in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], part, pa.array(whole, pa.binary())], [key, "ids", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(frugal(run), f"`{key}` {kind}, ids array<int>, decoded binary")


def digests(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): what :func:`encode` gives for each text and :func:`decode` for its ids, hashed.

    Both are done where the text is, in one pass, so that neither ids nor bytes leave the worker. ids_sha256 is of the decimal ids
    joined by one space; both are lowercase hex.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        decimal = list(map(str, range(len(vocabulary.tokens))))
        for batch in batches:
            texts = texts_of(batch, "_text")
            for first, last in _parts(offsets(texts)):
                counts, spelled, decoded = [], [], []
                for t in texts[first:last].to_pylist():
                    ids = encoder.encode(t)
                    counts.append(len(ids))
                    spelled.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                columns = [pa.array(counts, pa.int64()), pa.array(spelled), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], *columns], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(frugal(run), shape)
