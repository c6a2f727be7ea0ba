"""Cross-tokenizer alignment: the places where tokens of two tokenizers end together."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import fresh, frugal, offsets, texts_of, write_once

#: Bytes of text, or numbers of a list, that a worker handles at once; one longer text is taken alone.
PART = 1 << 19
#: Bytes of new words that are encoded in one call.
CALL = 1 << 18
#: Words of at most 64 characters, and tokens, that a worker remembers; beyond either it starts anew.
CACHE, CACHED_TOKENS = 1 << 16, 1 << 20


class Tokenizers(NamedTuple):
    """Both tokenizers by value: the bytes of each token, how A cuts words, and the model of B."""

    name: str
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    pattern: str
    model: bytes
    by_word: bool


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def load(json_path: str, model_path: str, pattern: str) -> Tokenizers:
    """Both tokenizers from files of the driver; they are sent along with the job.

    A is a byte-level BPE whose ids are ranks, with ``pattern`` for its words. Merging any neighbours that spell a token, lowest
    rank first, is then the same as merging listed pairs, if every token alone is merged to itself: what stands before a token's
    last merge depends on its bytes only. This, and that its merges come in order of ids, is checked here.
    """
    # Only the driver needs this library.
    import tokenizers

    with open(json_path, encoding="utf-8") as lines:
        text = lines.read()
    with open(model_path, "rb") as data:
        model = data.read()
    spec, letters = json.loads(text), _byte_letters()
    special, vocab = {t["id"] for t in spec["added_tokens"]}, spec["model"]["vocab"]
    own = {t: i for t, i in vocab.items() if i not in special}
    byte_level = tokenizers.Tokenizer.from_str(text).model
    if (
        spec["normalizer"] is not None
        or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        or sorted(own.values()) != list(range(len(own)))
        or any(vocab["".join(m)] != 256 + i for i, m in enumerate(spec["model"]["merges"]))
        or any([x.id for x in byte_level.tokenize(t)] != [i] for t, i in own.items())
    ):
        raise ValueError(f"{json_path} is no byte-level BPE with ids in order of merges")
    bytes_a = [b""] * len(own)
    for token, i in own.items():
        bytes_a[i] = bytes(map(letters.__getitem__, token))
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    bytes_b = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    by_word = not any(re.search(b"[^ ] ", t) for t in bytes_b)
    return Tokenizers(xxhash.xxh3_128_hexdigest(text.encode() + model + pattern.encode()), bytes_a, bytes_b, pattern, model, by_word)


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of either side that end where one of the other ends, in order."""
    at_a, at_b = ({end: i for i, end in enumerate(x)} for x in (ends_a, ends_b))
    common = sorted(at_a.keys() & at_b.keys())
    return tuple(np.fromiter(map(x.__getitem__, common), np.int64, len(common)) for x in (at_a, at_b))


def _taken(flat: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The entries of some of the lists that lie behind each other in ``flat``."""
    first, n = np.cumsum(counts) - counts, counts[numbers]
    return flat[np.repeat(first[numbers] - np.cumsum(n) + n, n) + np.arange(n.sum())]


#: A blank beside a space; an end of the text counts as one.
_BESIDE = re.compile(r"(?:\A|\s) | (?:\s|\Z)")
_NONE = np.zeros(0, np.int64)


class Pair:
    """The worker's two tokenizers, and the words that it has aligned.

    Neither tokenizer has a token that goes on from another character into a space, and both put a cut before a single space
    that follows a word. So in a text without a blank beside a space both have an end at each space, and the words between
    spaces are aligned apart, each new word once: new words are joined by spaces, encoded in few calls, and cut
    again at their ends. Any other text is one word here.
    """

    def __init__(self, files: Tokenizers):
        self.files, self.by_word = files, files.by_word
        ranks = {t: i for i, t in enumerate(files.bytes_a)}
        self.byte_level = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files.model)
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in (files.bytes_a, files.bytes_b)]
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.total = 0
        #: By a word's number: is it spelled, its tokens of A and of B, its groups; then ids_a, ids_b, sizes_a, sizes_b of all words.
        self.columns = [[np.zeros(0, t)] for t in (bool, *[np.int64] * 3, *[np.int32] * 4)]

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """The ids of space + text by both, or None if either does not spell it."""
        ids = self.byte_level.encode_ordinary(" " + text), self.pieces.encode(text, num_threads=1)
        want = b" " + text.encode()
        spelled = all(b"".join(map(t.__getitem__, i)) == want for t, i in zip((self.files.bytes_a, self.files.bytes_b), ids, strict=True))
        return ids if spelled else None

    def learn(self, words: list[str]) -> None:
        """Align some words that are apart, or one text."""
        ids = self.encode(" ".join(words))
        if ids is None and len(words) > 1:
            half = len(words) // 2
            self.learn(words[:half])
            self.learn(words[half:])
            return
        self.numbers.update(zip(words, range(self.total, self.total + len(words)), strict=True))
        self.total += len(words)
        ends = [np.cumsum(n[np.array(i, np.int64)]) for n, i in zip(self.lengths, ids or ([], []), strict=True)]
        last = common_ends(*(e.tolist() for e in ends))
        groups = ends[0][last[0]]
        stops = np.cumsum([len(w.encode()) + 1 for w in words]) if ids else np.zeros(len(words), np.int64)
        per_word = [np.diff(np.searchsorted(x, stops, "right"), prepend=0) for x in (*ends, groups)]
        lists = [np.array(x, np.int32) for x in (*(ids or ([], [])), *(np.diff(x, prepend=-1) for x in last))]
        for column, x in zip(self.columns, (np.full(len(words), ids is not None), *per_word, *lists), strict=True):
            column.append(x)

    def align(self, texts: list[str]) -> list[pa.ListArray]:
        """ids_a, ids_b, sizes_a and sizes_b of each text."""
        if self.total >= CACHE or sum(map(len, self.columns[4])) >= CACHED_TOKENS:
            self.forget()
        whole = [t if t and not (self.by_word and not _BESIDE.search(t)) else None for t in texts]
        words = [[t] if w is not None else t.split(" ") if t else [] for t, w in zip(texts, whole, strict=True)]
        texts_new = {w for w in whole if w is not None and w not in self.numbers}
        for t in texts_new:
            self.learn([t])
        new = [w for w in set(chain.from_iterable(words)) if w not in self.numbers]
        apart, size = [], 0
        for w in new:
            apart.append(w)
            size += len(w) + 1
            if size >= CALL:
                self.learn(apart)
                apart, size = [], 0
        if apart:
            self.learn(apart)
        self.columns = [[np.concatenate(c)] for c in self.columns]
        spelled, *counts = [c for (c,) in self.columns[:4]]
        per_text = np.array([len(w) for w in words], np.int64)
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, per_text.sum())
        text = np.repeat(np.arange(len(texts)), per_text)
        bad = np.zeros(len(texts), bool)
        bad[text[~spelled[numbers]]] = True
        numbers, text = numbers[~bad[text]], text[~bad[text]]
        lists = []
        for (flat,), n in zip(self.columns[4:], (*counts, counts[2]), strict=True):
            ends = np.append(0, np.cumsum(np.bincount(text, n[numbers], len(texts)).astype(np.int64)))
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_taken(flat, n, numbers), pa.int32())))
        for w in chain(texts_new, new):
            if len(w) > 64:
                del self.numbers[w]
        return lists


_PAIRS: dict[str, Pair] = {}


def pair_of(files: Tokenizers) -> Pair:
    """The worker's tokenizers, kept from task to task."""
    if files.name not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[files.name] = Pair(files)
    return _PAIRS[files.name]


ALIGNED = ["ids_a", "ids_b", "sizes_a", "sizes_b"]


def align(docs: DataFrame, files: Tokenizers, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ids_a, ids_b (array of int) and sizes_a, sizes_b, the tokens of either side in each group.

    Both tokenizers encode space + text without special tokens (the second adds the space itself); their strings in a
    text are plain text. Offsets in bytes at which tokens of both end cut the ids into groups, the last of which ends with the text. Texts that are null
    or empty, or that the tokens of either side do not spell byte by byte, have four empty lists. Rows are encoded one by one,
    whatever their keys, and repeated rows stay. Columns of the four names in ``docs`` are replaced.
    """
    docs = docs.drop(*ALIGNED)
    work, width = fresh(docs, "_work"), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ALIGNED]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(files)
        for batch in batches:
            texts = texts_of(batch, work)
            for first, last in _parts(offsets(texts), PART):
                extra = pair.align(texts[first:last].to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns[:width], *extra], schema.names)

    return docs.withColumn(work, docs[text]).mapInArrow(frugal(run), schema)


def _parts(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of rows with about ``limit`` units, or one longer row; ``at`` is where rows start."""
    first = 0
    while first < len(at) - 1:
        last = min(len(at) - 1, max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1))
        yield first, last
        first = last


class Aligned:
    """Some rows of an aligned table as flat arrays: ids, group sizes and links of all rows behind each other."""

    def __init__(self, batch: pa.RecordBatch):
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ALIGNED]
        self.a, self.b, self.sizes_a, self.sizes_b = (c.flatten().to_numpy() for c in columns)
        self.n_a, self.n_b, self.n_groups, _ = (np.diff(offsets(c)) for c in columns)
        ends_a, ends_b = np.cumsum(self.sizes_a, dtype=np.int64), np.cumsum(self.sizes_b, dtype=np.int64)
        #: Each group holds one link: the tokens that end with it.
        self.links = self.a[ends_a - 1].astype(np.int64) << 32 | self.b[ends_b - 1]


def _per_row(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of a number of each link over the links of each row."""
    total, ends = np.append(0, np.cumsum(x, dtype=np.int64)), np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _spelled(rows: Aligned, words: list[str], n: int) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` of each row; ``words`` has each id of A with a comma, with a bar, and of B with a comma, with a semicolon."""
    group = np.arange(len(rows.sizes_a))
    last_a, last_b = (np.zeros(len(x), np.int64) for x in (rows.a, rows.b))
    last_a[np.cumsum(rows.sizes_a) - 1] = last_b[np.cumsum(rows.sizes_b) - 1] = 1
    word = np.concatenate([rows.a + last_a * n, rows.b + (2 + last_b) * n])
    order = np.argsort(np.concatenate([2 * np.repeat(group, rows.sizes_a), 2 * np.repeat(group, rows.sizes_b) + 1]), kind="stable")
    flat, at = word[order].tolist(), 0
    for size in (rows.n_a + rows.n_b).tolist():
        yield "".join(map(words.__getitem__, flat[at : at + size]))[:-1]
        at += size


def _keys(links: pa.Array, kind: type) -> np.ndarray:
    """The links of some rows as numbers, the id of A above that of B."""
    at = offsets(links)
    if at[-1] == at[0]:
        return np.zeros(0, np.int64)
    pairs = np.frombuffer(links.buffers()[2], np.uint8)[at[0] : at[-1]].view(kind).reshape(-1, 2).astype(np.int64)
    return pairs[:, 0] << 32 | pairs[:, 1]


def linked(docs: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, groups_sha256, links) of each row, aligned as by :func:`align`.

    groups_sha256 is of the decimal ids, ``a1,a2|b1;a3|b2,b3``, and empty for a row without tokens. links has the ids of each link
    behind each other, in two bytes each if the vocabularies allow: lists of numbers would be many times as long on their way.
    """
    kind, n = _width(files), max(len(files.bytes_a), len(files.bytes_b))
    names = [key, "n_a", "n_b", "n_groups", "groups_sha256", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, words = pair_of(files), [f"{i}{end}" for end in ",|,;" for i in range(n)]
        for batch in batches:
            texts = texts_of(batch, "_text")
            for first, last in _parts(offsets(texts), PART):
                rows = Aligned(pa.RecordBatch.from_arrays(pair.align(texts[first:last].to_pylist()), ALIGNED))
                digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in _spelled(rows, words, n)]
                data = np.stack([rows.links >> 32, rows.links & 0xFFFFFFFF], axis=1).astype(kind)
                ends = np.append(0, np.cumsum(rows.n_groups)) * data.itemsize * 2
                links = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])
                sizes = [pa.array(c, pa.int64()) for c in (rows.n_a, rows.n_b, rows.n_groups)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], *sizes, pa.array(digests, pa.string()), links], names)

    numbers = [T.StructField(c, T.LongType()) for c in names[1:4]]
    schema = T.StructType([docs.schema[key], *numbers, T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])
    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(frugal(run), schema)


def _width(files: Tokenizers) -> type:
    return np.uint16 if max(len(files.bytes_a), len(files.bytes_b)) <= 1 << 16 else np.uint32


def pair_counts(rows: DataFrame, files: Tokenizers) -> DataFrame:
    """(a, b, n): how many links of the whole table of :func:`linked` rows hold each pair of ids; each task sums its own before they move."""
    kind = _width(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for first, last in _parts(offsets(batch.column(0)), PART):
                own, n = np.unique(_keys(batch.column(0)[first:last], kind), return_counts=True)
                keys, at = np.unique(np.concatenate([keys, own]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, n])).astype(np.int64)
        columns = [keys >> 32, keys & 0xFFFFFFFF, counts]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

    return rows.select("links").mapInArrow(frugal(run), "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Counts(NamedTuple):
    """Pairs of ids (a * 2^32 + b, ascending), their counts, and whether a count is the highest of its b."""

    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def collect_counts(counted: DataFrame) -> Counts:
    """The counts of all pairs, on the driver.

    The vocabularies bound them, whatever the corpus: of two tokens that end together one is an ending of the
    other, so there are at most as many pairs as endings of tokens, their bytes in all (and again for second spellings).
    """
    rows = counted.toArrow()
    a, b, n = (rows[c].to_numpy() for c in ("a", "b", "n"))
    keys = a << 32 | b
    order = np.argsort(keys)
    top = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(top, b, n)
    return Counts(keys[order], n[order], (n == top[b])[order])


def link(docs: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum) of each row of ``docs``.

    A link is a pair of tokens that end together, one for each group. n_best counts the links whose pair is, over all rows, the most
    frequent of its id of B, ties included; count_sum adds the counts of the pairs of all links. Zeros without tokens.
    """
    rows = write_once(linked(docs, files, key, text), "linked")
    counts, kind = collect_counts(pair_counts(rows, files)), _width(files)
    told = [key, "n_a", "n_b", "n_groups", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in _parts(offsets(batch.column(5)), PART):
                part = batch.slice(first, last - first)
                at, sizes = np.searchsorted(counts.keys, _keys(part.column(5), kind)), part.column(3).to_numpy()
                sums = [sizes, _per_row(counts.best[at], sizes), _per_row(counts.counts[at], sizes)]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], *[pa.array(x, pa.int64()) for x in sums]], [*told, "n_links", "n_best", "count_sum"])

    schema = T.StructType([*[rows.schema[c] for c in told], *[T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]])
    return rows.mapInArrow(frugal(run), schema)
