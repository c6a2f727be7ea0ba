"""Periodic runs of words: difference-cover LCE drives the enumeration of runs on harmonic grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexmill.llm.common import fresh, pieces, texts_of
from lexmill.llm.substring import word_hashes

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The modulus of the difference cover is the square of this.
ROOT = 8
#: Questions that are answered at once, each with up to ROOT * ROOT words compared.
ASKED = 1 << 14


def difference_cover(root: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, first): which residues modulo root^2 are in the cover, and for each difference d a member x with x + d in it.

    The cover is 0 to root - 1 and the multiples of root: every d is k * root - j.
    """
    v = root * root
    member = np.zeros(v, bool)
    member[:root] = member[::root] = True
    first = np.zeros(v, np.int64)
    for d in range(v):
        first[d] = next(x for x in range(v) if member[x] and member[(x + d) % v])
    return member, first


class CommonExtension:
    """Longest common extensions (LCE) of a sequence of numbers, each question in constant time.

    Only the suffixes that start at the difference cover are sorted: by their first v numbers, then by doubling. For two
    places some shift below v brings both onto the cover, so fewer than v numbers are compared, and the rest
    is the least entry between two ranks, read from a sparse table.
    """

    def __init__(self, codes: np.ndarray, root: int = ROOT):
        self.n, self.v = len(codes), root * root
        member, self.first = difference_cover(root)
        # Numbers of their own beyond the end: no two suffixes are equal.
        top = int(codes.max()) + 1 if self.n else 0
        self.codes = np.concatenate([codes, np.arange(top, top + 2 * self.v)]).astype(np.int64)
        at = np.flatnonzero(member[np.arange(self.n + self.v) % self.v])
        self.index = np.full(self.n + 2 * self.v, -1, np.int64)
        self.index[at] = np.arange(len(at))
        levels = [self._blocks(at)]
        while levels[-1].max() + 1 < len(at):
            # The next v * 2^k numbers start at the cover again.
            ahead = at + (self.v << (len(levels) - 1))
            known = ahead < self.n + self.v
            after = np.full(len(at), -1, np.int64)
            after[known] = levels[-1][self.index[ahead[known]]]
            levels.append(np.unique(levels[-1] * (len(at) + 2) + after + 1, return_inverse=True)[1])
        self.rank = levels[-1]
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        self.least = [self._neighbours(at[order], levels)]
        while 2 << len(self.least) - 1 <= len(at) - 1:
            row, half = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(row[:-half], row[half:]))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """The rank of the first v numbers from each place."""
        keys = [self.codes[at + k] << 32 | self.codes[at + k + 1] for k in range(0, self.v, 2)]
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, at: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """How many numbers each sorted suffix shares with the next: whole blocks by their ranks, then number by number."""
        a, b = at[:-1].copy(), at[1:].copy()
        for k in reversed(range(len(levels))):
            inside = np.maximum(a, b) < self.n + self.v
            i, j = (np.where(inside, self.index[np.where(inside, x, 0)], 0) for x in (a, b))
            step = np.where(inside & (levels[k][i] == levels[k][j]), self.v << k, 0)
            a, b = a + step, b + step
        return a - at[:-1] + self._compared(a, b, np.full(len(a), self.v))

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The common numbers of the next ``most`` (at most v)."""
        out, ahead = np.zeros(len(a), np.int64), np.arange(self.v)
        for s in range(0, len(a), ASKED):
            i, j = (np.minimum(x[s : s + ASKED, None] + ahead, len(self.codes) - 1) for x in (a, b))
            differ = (self.codes[i] != self.codes[j]) | (ahead >= most[s : s + ASKED, None])
            out[s : s + ASKED] = np.where(differ.any(axis=1), differ.argmax(axis=1), self.v)
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The common extension from the places i and j > i, elementwise."""
        shift = (self.first[(j - i) % self.v] - i) % self.v
        found = self._compared(i, j, shift)
        on = np.flatnonzero((found == shift) & (j + shift < self.n))
        p, q = (self.rank[self.index[x[on] + shift[on]]] for x in (i, j))
        p, q = np.minimum(p, q), np.maximum(p, q)
        level = np.frexp((q - p).astype(float))[1] - 1
        for k in np.unique(level):
            at = level == k
            row = self.least[k]
            found[on[at]] += np.minimum(row[p[at]], row[q[at] - (1 << int(k))])
        return found


def _chains(h: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(period, places): grid places that could lie in a run, from equal hashes a period apart.

    A run of period p and three periods holds two neighbouring multiples of p at which the word equals the word p
    later; the second of them is given.
    """
    for p in range(1, longest // LEAST_PERIODS + 1):
        same = h[0 : len(h) - p : p] == h[p::p]
        twice = np.flatnonzero(same[1:] & same[:-1])
        if len(twice):
            yield p, (twice + 1) * p


def _outside(at: np.ndarray, p: int, spans: np.ndarray) -> np.ndarray:
    """The places that do not lie, with the place p later, in one of the spans (rows of starts and ends, both ascending)."""
    of = np.searchsorted(spans[0], at, "right") - 1
    return at[(of < 0) | (at + p > spans[1][of])]


def runs_of(codes: np.ndarray, candidates: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """(start, length, smallest period) of each run that a candidate lies in, in order of start and period.

    ``candidates`` come by ascending period. One that lies with the place a period later in a run whose period divides its own would
    give that run again: a stretch of period p is periodic by q if p of its words are and q divides p. It is left out.
    """
    forward, backward = CommonExtension(codes), CommonExtension(codes[::-1])
    n, known = len(codes), {}
    for p, at in candidates:
        for q in [q for q in known if p % q == 0]:
            at = _outside(at, p, known[q])
        while len(at):
            i, at = at[:ASKED], at[ASKED:]
            start = i - backward(n - i - p, n - i)
            end = i + p + forward(i, i + p)
            good = end - start >= max(LEAST_WORDS, LEAST_PERIODS * p)
            if good.any():
                spans = np.stack([start[good], end[good]])
                known[p] = np.unique(np.hstack([known[p], spans]) if p in known else spans, axis=1)
                at = _outside(at, p, known[p])
    if not known:
        return np.zeros((0, 3), np.int64)
    start, end, period = np.hstack([np.vstack([spans, np.full(spans.shape[1], q)]) for q, spans in known.items()])
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # A stretch that also has multiples of its period is one run.
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
    runs = np.stack([start, end - start, period], axis=1)[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _piece_runs(texts: list[bytes], data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The runs of each text of a piece."""
    none = np.zeros((0, 3), np.int64)
    h, text = word_hashes(data, starts)
    counts = np.bincount(text, minlength=len(texts))
    longest = int(counts.max(initial=0))
    if longest < LEAST_WORDS:
        return [none] * len(texts)
    # One sequence of all texts, with a number of its own after each.
    place = np.arange(len(h)) + text
    line = np.arange(len(h) + len(texts), dtype=np.uint64)
    line[place] = h | np.uint64(1 << 63)
    own = np.searchsorted(np.cumsum(counts + 1), np.arange(len(line)), "right")
    first = np.append(0, np.cumsum(counts + 1))
    hits: dict[int, list[tuple[int, np.ndarray]]] = {}
    for p, at in _chains(line, longest):
        at = at[own[at] == own[at + p]]
        if len(at) == 0:
            continue
        cut = np.flatnonzero(np.append(True, own[at][1:] != own[at][:-1]))
        for part in np.split(at, cut[1:]):
            hits.setdefault(int(own[part[0]]), []).append((p, part))
    out = [none] * len(texts)
    for i, found in hits.items():
        ids: dict[bytes, int] = {}
        codes = np.array([ids.setdefault(w, len(ids)) for w in texts[i].split()], np.int64)
        out[i] = runs_of(codes, [(p, at - first[i]) for p, at in found])
    return out


def collapsed(text: bytes, runs: np.ndarray) -> str:
    """The words, joined by one space, without those that a run holds after its first period."""
    words = text.split()
    if len(runs):
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
    return b" ".join(words).decode()


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with runs (array of start, length, period) and collapsed, the text without repetitions.

    A run is a stretch of the text's words with smallest period q (words q apart are equal) and a length of 24 words and 3 q at
    least, that no neighbouring word extends; words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A stretch that also has
    multiples of q as periods is one run; runs of different periods may overlap. Runs are ordered by start, then period. collapsed
    has the words, joined by one space, that no run holds after its first q words. Null, empty and blank texts: no
    runs, collapsed is empty. Rows are judged one by one, whatever their keys, and repeated rows stay. Columns of the two
    names in ``docs`` are replaced.

    Whole texts are taken in pieces of bounded bytes (one longer text is a piece of its own) and nothing is shuffled. Word hashes
    on the grid of each period rule out most places; texts with a place left are coded by their words, exactly.
    """
    docs = docs.drop("runs", "collapsed")
    work = fresh(docs, "_work")
    schema = T.StructType([*docs.schema.fields, T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts_of(batch, work)
            for first, last, data, starts in pieces(column):
                texts = [data[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                found = _piece_runs(texts, data, starts)
                ends = np.cumsum([0, *map(len, found)])
                flat = np.concatenate(found).T
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat], fields=list(_RUN))
                extra = [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pa.array([collapsed(t, r) for t, r in zip(texts, found, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns[:width], *extra], schema.names)

    return docs.withColumn(work, docs[text]).mapInArrow(run, schema)
