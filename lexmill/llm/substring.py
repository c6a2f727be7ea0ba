"""Substring deduplication by phrases cut at minimisers, in place of relative Lempel-Ziv parsing against indexed blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import attach, byte_codes, fresh, frugal, gathered, mixed, pieces, segment_hashes, texts_of, write_once
from lexmill.operators.scale import with_order_index
from lexmill.runtime import ROW, numbered, shuffle_partitions

#: Words of a window, words of an anchor, and windows of a phrase at most.
WINDOW, ANCHOR, PHRASE = 20, 8, 16
HELD = 1 << 18
CODES = byte_codes()
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
KNOWN, OPEN, PHRASES = 0, 1, 2


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of some texts, and the text that it is of."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = SPACE[data]
    edge = np.append(True, blank[1:] != blank[:-1])
    edge[starts[:-1][starts[:-1] < len(data)]] = True
    at = np.flatnonzero(edge)
    hashes, word = segment_hashes(CODES[data], at, len(data)), ~blank[at]
    return hashes[word], np.searchsorted(starts, at[word], "right") - 1


def _rolled(h: np.ndarray, n: int, by: int) -> np.ndarray:
    """The polynomial of each n neighbours, put together from runs of 1, 2, 4 ... of them."""
    factor, width, run, done, out = np.uint64(by), 1, h, 0, None
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                out = run if out is None else out[: len(run) - done] * factor + run[done:]
                done += width
            if 2 * width > n:
                return out[: len(h) - n + 1]
            run = run[: len(run) - width] * factor + run[width:]
            factor, width = factor * factor, 2 * width


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    width, run = 1, h
    while 2 * width <= n:
        run, width = np.minimum(run[: len(run) - width], run[width:]), 2 * width
    return np.minimum(run[: len(h) - n + 1], run[n - width :][: len(h) - n + 1])


class Windows:
    """All windows of some texts: their text, place, hash, check and anchor."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        h, text = word_hashes(data, starts)
        self.words = np.bincount(text, minlength=len(starts) - 1)
        n = len(h) - WINDOW + 1
        if n <= 0:
            self.text = self.place = np.zeros(0, np.int64)
            self.hash = self.check = self.anchor = np.zeros(0, np.uint64)
            return
        anchors = mixed(_rolled(h, ANCHOR, 0x9FB21C651E98DF25))
        least = _least(anchors, WINDOW - ANCHOR + 1)[:n]
        first = np.cumsum(self.words) - self.words
        inside = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
        self.text = text[inside]
        self.place = inside - first[self.text]
        self.hash = mixed(_rolled(h, WINDOW, 0x9E3779B97F4A7C15))[inside]
        self.check = mixed(_rolled(h, WINDOW, 0xC2B2AE3D27D4EB4F))[inside]
        self.anchor = least[inside]
        self._anchors, self._least, self._inside = anchors, least, inside

    def anchor_places(self) -> tuple[np.ndarray, np.ndarray]:
        """How often its anchor stands in each window, and the sum of the places."""
        times, places = np.zeros(len(self._least), np.int64), np.zeros(len(self._least), np.int64)
        for k in range(WINDOW - ANCHOR + 1):
            here = self._anchors[k : k + len(self._least)] == self._least
            times += here
            places += here * np.arange(k, k + len(self._least))
        return times[self._inside], places[self._inside]


def _rows(kind: int, doc, start, n, anchor=None, hash=None, check=None) -> pa.RecordBatch:
    none = np.zeros(len(doc), np.int64)
    columns = [
        pa.array(np.full(len(doc), kind, np.int32)), pa.array(doc), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
        *[pa.array(none if x is None else x.view(np.int64)) for x in (anchor, hash)],
        pa.array(np.zeros(len(doc), np.int32) if check is None else (check >> np.uint64(33)).astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, FIELDS)


FIELDS = ["kind", "doc", "start", "n", "anchor", "hash", "check"]
ROWS = "kind int, doc bigint, start int, n int, anchor bigint, hash bigint, check int"


def _joined(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one document (first window, windows) that touch or overlap, joined; sorted."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), (start + n)[order].astype(np.int64)
    if len(doc) == 0:
        return doc, start, end
    # Within a document the furthest end so far: documents are kept apart by a step larger than any place.
    rank = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * step) - rank * step
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    return doc[new], start[new], reach[last] - start[new]


def _settle(held: list[tuple[np.ndarray, ...]], phrases: bool) -> Iterator[pa.RecordBatch]:
    """Settle among the rows of one task what can be, so that a common passage gives few rows to the shuffle.

    Of equal rows the first place stays, any later one is KNOWN. Of an anchor with several phrases two are sent on, and
    all of them are OPEN: their windows have to be looked at one by one. So is a phrase in which its anchor
    stands more than once (``again``), since one of its windows may equal another.
    """
    anchor, hash, check, doc, start, n, again = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((start, doc, check, hash, anchor))
    anchor, hash, check, doc, start, n, again = (x[order] for x in (anchor, hash, check, doc, start, n, again))
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (hash[1:] != hash[:-1]) | (check[1:] != check[:-1]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[first]) | (start != start[first])
    yield _rows(KNOWN, *_joined(doc[later], start[later], n[later]))
    anchor, hash, check, doc, start, n, again = (x[new] for x in (anchor, hash, check, doc, start, n, again))
    if phrases:
        head = np.append(True, anchor[1:] != anchor[:-1])
        of = np.cumsum(head) - 1
        several = (np.bincount(of)[of] > 1) | again
        yield _rows(OPEN, doc[several], start[several], n[several])
        sent = np.arange(len(anchor)) - np.flatnonzero(head)[of] < 2
        anchor, hash, check, doc, start, n = anchor[sent], hash[sent], check[sent], doc[sent], start[sent], n[sent]
    for i in range(0, len(doc), 1 << 16):
        yield _rows(PHRASES, *(x[i : i + (1 << 16)] for x in (doc, start, n, anchor, hash, check)))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut each text into phrases: runs of windows with one anchor, the least hash of the 8-word sequences inside.

    Equal windows have equal anchors, so equal passages are cut alike but for their ends. Two windows at most
    ``PHRASE`` places apart cover a phrase, and their hashes tell it.
    """
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last, data, starts in pieces(texts_of(batch)):
            w = Windows(data, starts)
            if len(w.text) == 0:
                continue
            new = np.append(True, (w.anchor[1:] != w.anchor[:-1]) | (w.text[1:] != w.text[:-1]))
            head = np.flatnonzero(new)
            new |= (np.arange(len(new)) - head[np.cumsum(new) - 1]) % PHRASE == 0
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(new)) - 1
            n = tail - head + 1
            times, places = w.anchor_places()
            again = (np.maximum.reduceat(times, head) > 1) | (np.maximum.reduceat(places, head) > np.minimum.reduceat(places, head))
            hash = mixed(w.hash[head] * np.uint64(3) + w.hash[tail] * np.uint64(5) + n.astype(np.uint64))
            check = mixed(w.check[head] * np.uint64(7) + w.check[tail] + n.astype(np.uint64))
            held.append((w.anchor[head], hash, check, ids[first:last][w.text[head]], w.place[head], n, again))
            size += len(head)
            if size >= HELD:
                yield from _settle(held, True)
                held, size = [], 0
    if held:
        yield from _settle(held, True)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of the open phrases of each text."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        opened, counts = batch.column(2), batch.column(3)
        for first, last, data, starts in pieces(texts_of(batch)):
            w = Windows(data, starts)
            asked = np.zeros(len(w.text) + 1, np.int64)
            own = np.append(np.searchsorted(w.text, np.arange(last - first)), len(w.text))
            for i in range(last - first):
                at, n = (np.asarray(x[first + i].values).astype(np.int64) for x in (opened, counts))
                room = own[i + 1] - own[i]
                np.add.at(asked, own[i] + np.minimum(at, room), 1)
                np.add.at(asked, own[i] + np.minimum(at + n, room), -1)
            at = np.flatnonzero(np.cumsum(asked)[:-1] > 0)
            none = np.zeros(len(at), np.uint64)
            held.append((none, w.hash[at], w.check[at], ids[first:last][w.text[at]], w.place[at], np.ones(len(at), np.int64), np.zeros(len(at), bool)))
            size += len(at)
            if size >= HELD:
                yield from _settle(held, False)
                held, size = [], 0
    if held:
        yield from _settle(held, False)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its runs of windows, joined."""
    rows = gathered(batches, pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]))
    doc, start, n = _joined(*(c.to_numpy() for c in rows.columns))
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    ends = pa.array(np.append(head, len(doc)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (start, n)]
    yield pa.RecordBatch.from_arrays([pa.array(doc[head]), *lists], ["doc_id", "starts", "counts"])


def _per_document(runs: DataFrame, name: str) -> DataFrame:
    parts = shuffle_partitions(runs.sparkSession)
    return write_once(runs.repartition(parts, "doc").mapInArrow(frugal(_lists), "doc_id bigint, starts array<int>, counts array<int>"), name)


def _placed(docs: DataFrame, place: str) -> DataFrame:
    """``docs`` with a number for each row, in order of doc_id; null without one. Rows of one doc_id are apart, in order of a row number written here."""
    rows = write_once(numbered(docs), "numbered")
    known = rows.where(F.col("doc_id").isNotNull()).select("doc_id", ROW)
    places = write_once(with_order_index(known, place, [F.col("doc_id"), F.col(ROW)]).select(ROW, place), "places")
    return rows.join(places, ROW, "left").select(*docs.columns, place)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, starts, counts): the runs of windows of each document whose words also start earlier; written.

    ``docs`` has doc_id, each but null once, and text. Every document is held, by hashes of phrases, against the reference, which is the first place of
    each phrase of the corpus, spread by anchor over the tasks. A phrase found at an earlier place is a factor, and
    neighbouring factors join. Where factors end, phrases of one anchor differ: their windows are checked one by one in the same
    way. Each task first settles what repeats within it, so a passage that a third of all documents share comes to the
    shuffle once per task. A place is smaller by doc_id, then by word.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    parsed = write_once(known.mapInArrow(frugal(_parse), ROWS), "phrases")
    place = F.struct("doc", "start")
    phrases = parsed.where(F.col("kind") == PHRASES).drop("kind").repartition(shuffle_partitions(spark), "anchor")
    same = Window.partitionBy("anchor", "hash", "check").orderBy("doc", "start")
    ends = Window.partitionBy("anchor")
    judged = phrases.withColumn("first", F.first(place).over(same))
    judged = judged.withColumn("least", F.min("hash").over(ends)).withColumn("most", F.max("hash").over(ends))
    judged = judged.withColumn("other", F.min("check").over(ends) != F.max("check").over(ends))
    later = place > F.col("first")
    opened = (F.col("least") != F.col("most")) | F.col("other")
    judged = judged.where(later | opened).select(F.when(later, KNOWN).otherwise(OPEN).alias("kind"), "doc", "start", "n")
    judged = write_once(judged, "judged")
    both = parsed.where(F.col("kind") != PHRASES).select("kind", "doc", "start", "n").union(judged)
    opened = _per_document(both.where(F.col("kind") == OPEN).drop("kind"), "open")
    single = attach(known, opened).where(F.col("starts").isNotNull()).select("doc.*", "starts", "counts")
    windows = write_once(single.mapInArrow(frugal(_windows), ROWS), "windows")
    again = windows.where(F.col("kind") == PHRASES)
    again = again.withColumn("first", F.min(place).over(Window.partitionBy("hash", "check"))).where(place > F.col("first"))
    runs = both.where(F.col("kind") == KNOWN).select("doc", "start", "n")
    runs = runs.union(windows.where(F.col("kind") == KNOWN).select("doc", "start", "n")).union(again.select("doc", "start", "n"))
    return _per_document(runs, "repeats")


def _kept(texts: list[str], starts: list, counts: list) -> Iterator[tuple[int, int, str | None]]:
    for text, at, n in zip(texts, starts, counts, strict=True):
        # The words of the operator are ASCII-separated; str.split would also cut at other blanks.
        words = text.encode().split()
        if at is None:
            yield len(words), 0, b" ".join(words).decode()
            continue
        kept, end = [], 0
        for start, count in zip(at, n, strict=True):
            kept += words[end : max(start, end)]
            end = max(end, start + count + WINDOW - 1)
        kept += words[end:]
        yield len(words), len(words) - len(kept), b" ".join(kept).decode()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) with n_words, n_removed and kept, the words left, joined by one space.

    A word goes if a window of 20 words of its document covers it whose words also start earlier, in a document of smaller
    doc_id or at an earlier word of the same; windows are judged on the input. Null, empty and blank texts have no words, kept is
    empty. A text below 20 words stays whole. A document with a null doc_id has no place in the order: it stays whole and
    takes nothing from others. Rows that repeat a doc_id are judged apart, one of them (the same one throughout a run) before the
    other. Columns of the three names in ``docs`` are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept")
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1)
    if not again.isEmpty():
        place, own = fresh(docs, "_place"), fresh(docs, "_doc")
        apart = remove_repeats(_placed(docs, place).withColumnRenamed("doc_id", own).withColumnRenamed(place, "doc_id"))
        return apart.drop("doc_id").withColumnRenamed(own, "doc_id").select(*docs.columns, "n_words", "n_removed", "kept")
    full = attach(docs, repeats(docs)).select("doc.*", *[F.col(c).alias(fresh(docs, c)) for c in ("starts", "counts")])
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            step = max(1, len(texts) * (8 << 20) // max(1, texts.nbytes))
            for i in range(0, len(texts), step):
                part = batch.slice(i, step)
                found = list(_kept(texts[i : i + step].to_pylist(), part.column(width).to_pylist(), part.column(width + 1).to_pylist()))
                n, gone, kept = zip(*found, strict=True)
                extra = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *extra], schema.names)

    return full.mapInArrow(frugal(run), schema)


def cut(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, and n_chars if it has it) with its columns and rows; text is what :func:`remove_repeats` keeps.

    A text of which nothing goes is not touched; n_chars follows a text that is.
    """
    named = docs.withColumnsRenamed({c: f"{c}_" for c in docs.columns if c.rstrip("_") in ("n_words", "n_removed", "kept")})
    left = remove_repeats(named)
    changed = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    left = left.withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
    return left.drop("n_words", "n_removed", "kept").toDF(*docs.columns)
