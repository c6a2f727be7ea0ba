import math
import random

import numpy as np
import pytest

from lexmill.llm import ann, embed_dedup
from llm import brute

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, id int, node int"


@pytest.fixture(scope="module")
def make_vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, "v", 1, 2) for i, v in rows], SCHEMA)


def _rows(n=300, d=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    near = x[:80] + rng.normal(size=(80, d)) * 0.05
    crowd = x[0] + rng.normal(size=(60, d)) * 0.1
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([x, near, crowd, x[:30] * 3]))]
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [math.nan] + [1.0] * (d - 1), [math.inf] + [1.0] * (d - 1), [1.0, 2.0], [1.0, 2.0]]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(2000 + i, rows[1][1]) for i in range(40)]
    random.Random(2).shuffle(rows)
    return rows


def _good(v, d):
    return brute.good_vector(v) and len(v) == d


@pytest.mark.parametrize("tile", [1024, 9])
def test_links_and_groups_equal_brute_force(make_vectors, monkeypatch, tile):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    rows = _rows()
    found = {r.vec_id: r for r in embed_dedup.near_duplicates(make_vectors(rows)).collect()}
    assert len(found) == len(rows)
    good = {i: v for i, v in rows if brute.good_vector(v)}
    linked = {(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b]) and brute.cosine(good[a], good[b]) >= 0.95}
    roots = brute.components(good, lambda a, b: (a, b) in linked)
    want = {i: sum((i, b) in linked for b in good) for i in good}
    reached = sum(found[i].n_links for i in good)
    assert reached >= 0.95 * len(linked) and all(found[i].n_links <= n for i, n in want.items())
    assert sum(found[i].component_id == roots[i] for i in good) >= 0.95 * len(good)
    for i, v in rows:
        assert found[i].kept == (found[i].component_id == i)
        if i not in good:
            assert (found[i].n_links, found[i].component_id) == (0, i), v


def test_repeated_rows_null_keys_and_no_vectors(make_vectors):
    v = [1.0, 2.0, 3.0]
    found = embed_dedup.near_duplicates(make_vectors([(5, v), (5, v), (3, v), (None, v), (9, [-1.0, 0.0, 0.0])])).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in found) == [(-1, 3, 3, False), (3, 3, 3, True), (5, 3, 3, False), (5, 3, 3, False), (9, 0, 9, True)]
    assert embed_dedup.near_duplicates(make_vectors([])).collect() == []
    assert [tuple(r) for r in embed_dedup.near_duplicates(make_vectors([(1, None)])).collect()] == [(1, 0, 1, True)]


def test_codes_are_balanced():
    x = np.random.default_rng(3).normal(size=(4000, 32)) + 0.5
    codes = embed_dedup.fit(x).codes(x)
    share = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :32].mean(axis=0)
    assert share.min() > 0.4 and share.max() < 0.6


def test_nearest_equal_brute_force(make_vectors, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 100)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rows = _rows(1500, 16, 4)
    vectors = make_vectors(rows)
    found = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, []).append(r)
    good = {i: np.asarray(v, float) for i, v in rows if _good(v, 16)}
    hits = total = 0
    assert set(found) == {i for i in good if i % 20 == 0}
    for q, got in found.items():
        got.sort(key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert all(r.score == pytest.approx(float(good[q] @ good[r.vec_id]), abs=1e-12) and r.vec_id != q for r in got)
        want = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)[:20]
        hits += len({i for _, i in want} & {r.vec_id for r in got})
        total += 20
    assert hits >= 0.9 * total


def test_few_repeated_and_no_candidates(make_vectors):
    v = [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]]
    vectors = make_vectors([(0, v[0]), (1, v[1]), (2, v[2]), (2, v[2]), (40, v[0]), (None, v[0]), (20, None)])
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=4).collect())
    assert found == [(0, 1, 2, 1.0), (0, 2, 2, 1.0), (0, 3, 40, 1.0), (0, 4, 1, 0.0), (40, 1, 0, 1.0), (40, 2, 2, 1.0), (40, 3, 2, 1.0), (40, 4, 1, 0.0)]
    assert ann.nearest(make_vectors([]), make_vectors([])).collect() == []
    assert ann.nearest(make_vectors([(0, v[0])]), make_vectors([(0, v[0])])).collect() == []


def _pairs_at(x, cosine, seed):
    """Unit vectors, and one at this cosine from each in a random direction."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    w = np.random.default_rng(seed).normal(size=x.shape)
    w -= np.sum(w * x, axis=1, keepdims=True) * x
    return x, cosine * x + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w, axis=1, keepdims=True)


def _met(a, b, masks, radius):
    differ = (a ^ b).view(np.uint64)
    near = np.any([np.bitwise_count(differ & np.uint64(m)) <= 1 for m in masks], axis=0)
    return float(np.mean(near & (np.bitwise_count(differ) <= radius)))


@pytest.mark.parametrize("mean", [0.0, 0.5, 2.0, 4.0])
def test_the_parts_and_the_radius_find_links_in_tables_of_any_size(mean):
    rng = np.random.default_rng(7)
    common = rng.normal(size=64)
    x, y = _pairs_at(rng.normal(size=(20_000, 64)) + mean * math.sqrt(64) * common / np.linalg.norm(common), 0.95, 8)
    coder = embed_dedup.fit(x)
    radius, cuts = embed_dedup._plan(x, coder, 0.95)
    assert _met(coder.codes(x), coder.codes(y), [m for _, m in cuts], radius) >= 0.999


def test_links_of_vectors_with_a_common_direction(make_vectors):
    rng = np.random.default_rng(9)
    common = 2 * math.sqrt(32) * rng.permutation(np.r_[np.ones(1), np.zeros(31)])
    x, y = _pairs_at(rng.normal(size=(150, 32)) + common, 0.955, 10)
    x = np.concatenate([x, y])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = (v @ v.T >= 0.95).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(make_vectors(rows)).collect()}
    assert all(found[i] <= n for i, n in enumerate(want)) and sum(found.values()) >= 0.99 * want.sum()


def test_extreme_numbers_and_rare_lengths_link_too(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(300, (x[0] * 1e200).tolist()), (301, (x[0] * 1e-200).tolist()), (302, (x[1] * 1e-290).tolist())]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 4.0]), (402, [1e300, -1e300]), (500, [3.0]), (501, [1e-320]), (502, [-3.0])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert [found[i] for i in (0, 300, 301)] == [(2, 0)] * 3 and found[1] == found[302] == (1, 1)
    assert found[400] == found[401] == (1, 400) and found[402] == (0, 402)
    assert found[500] == found[501] == (1, 500) and found[502] == (0, 502) and len(found) == len(rows)


def test_codes_that_meet_are_each_pair_once():
    from lexmill.llm.meeting import near_pairs

    rng = np.random.default_rng(6)
    codes = rng.integers(0, 1 << 9, 700).astype(np.uint64) << np.uint64(55)
    codes[:200] = codes[0]
    mask, first = 0b1111 << 59, 0b11 << 59
    for home in (np.ones(700, bool), codes & np.uint64(first) == codes[5] & np.uint64(first)):
        got = [tuple(sorted(p)) for i, j in near_pairs(codes, mask, home, 3) for p in zip(i.tolist(), j.tolist())]
        apart = codes[:, None] ^ codes
        near = (np.bitwise_count(apart & np.uint64(mask)) <= 1) & (np.bitwise_count(apart) <= 3) & (home[:, None] | home)
        same = near & (codes[:, None] & np.uint64(mask) == codes & np.uint64(mask)) & ~(home[:, None] & home)
        assert len(got) == len(set(got)) and set(got) == set(zip(*np.nonzero(np.triu(near & ~same, 1))))


def test_vectors_stay_where_they_are_unless_codes_meet(make_vectors, monkeypatch):
    from lexmill import runtime
    from lexmill.llm import common

    sizes, written = {}, common.materialize

    def noted(df, name):
        out = written(df, name)
        sizes[name] = sizes.get(name, 0) + runtime.measure(out).bytes
        return out

    monkeypatch.setattr(common, "materialize", noted)
    x = np.random.default_rng(12).normal(size=(3000, 64)).astype(np.float32)
    x[:20] = x[20:40] + 0.01
    assert sum(r.n_links for r in embed_dedup.near_duplicates(make_vectors([(i, v.tolist()) for i, v in enumerate(x)])).collect()) == 40
    # All tables but the bounded sample; the vectors themselves are 48 bytes a number here.
    assert sum(n for name, n in sizes.items() if name != "sample") < x.size * 48 / 4
