import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from lexmill.llm import periodic, queries
from llm import brute


def test_every_difference_is_in_the_cover():
    member, first = periodic.difference_cover(8)
    assert all(member[first[d]] and member[(first[d] + d) % 64] for d in range(64)) and member.sum() == 15


@pytest.mark.parametrize("letters", [1, 2, 40])
def test_common_extension_equals_comparison(letters):
    rng = np.random.default_rng(letters)
    codes = np.concatenate([rng.integers(0, letters, 300), np.tile(rng.integers(0, letters, 9), 40), rng.integers(0, letters, 77)])
    extension = periodic.CommonExtension(codes)
    pairs = np.sort(rng.integers(0, len(codes), (500, 2)), axis=1)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    for (i, j), n in zip(pairs.tolist(), extension(pairs[:, 0], pairs[:, 1]).tolist(), strict=True):
        assert n == next(k for k in range(len(codes) + 1) if j + k >= len(codes) or codes[i + k] != codes[j + k])


def _texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        k, w = rng.choice([1, 2, 3, 50]), []
        for _ in range(rng.randrange(7)):
            unit = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, rng.choice([3, 9, 70])))]
            w += (unit * 12)[: rng.randrange(1, 12 * len(unit) + 1)]
        yield "".join(x + rng.choice([" ", "\n", "\t ", "  "]) for x in w)


def test_runs_equal_the_plain_version(make_docs):
    rows = list(enumerate(_texts(5, 250)))
    edges = [None, "", " \n ", "a " * 23, "a " * 24, "a b " * 40_000, "x y z " * 8 + "x", " ".join(f"u{i}" for i in range(5000)) + " q r" * 50, "ab ab" + " ab" * 60]
    rows += [(1000 + i, t) for i, t in enumerate(edges)] + [(None, "k l m " * 9), (1004, "a " * 24), (1004, "b " * 30)]
    found = periodic.find_runs(make_docs(rows).repartition(3)).collect()
    got = sorted((str(r.doc_id), r.text or "", [tuple(x) for x in r.runs], r.collapsed.encode()) for r in found)
    want = []
    for i, t in rows:
        w = brute.words(t)
        # The plain version is quadratic: the longest of these texts is one run by construction.
        runs = [(0, 80_000, 2)] if len(w) == 80_000 else brute.runs(w)
        want.append((str(i), t or "", runs, brute.collapsed(w, runs)))
    assert got == sorted(want)
    assert periodic.find_runs(make_docs([])).collect() == []


def test_query_equals_the_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op11_periodic"](spark, small).collect()}
    some = 0
    for i, text in docs:
        w = brute.planted(i, text)
        runs = brute.runs(w) if len(w) < 3000 else None
        if runs is None:
            continue
        r, some = found[i], some + bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute.collapsed(w, runs)).hexdigest()
    assert len(found) == len(docs) and some > 10


def test_planted_texts(make_docs):
    rows = [(i, t) for i, t in enumerate(_texts(8, 120))] + [(None, "a b c"), (10_001, None), (10_002, "")]
    found = queries.planted(make_docs(rows)).collect()
    want = {i: brute.planted(i, t) for i, t in rows}
    assert len(found) == len(rows) and all(brute.words(r.text) == want[r.doc_id] for r in found)
