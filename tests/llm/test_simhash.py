import random

import numpy as np
import pytest

from lexmill.llm import hamming, simhash
from lexmill.llm.components import components
from lexmill.llm.tiles import tiles
from llm import brute


@pytest.mark.parametrize("radius", [0, 1, 3, 6, 12])
def test_bit_sliced_pairs_are_all_close_pairs(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    codes = np.concatenate([codes, codes[:100] ^ np.uint64(0b10101), codes[:50] ^ np.uint64((1 << 63) | 1)])
    groups = np.sort(rng.integers(0, 5, len(codes)))
    want = {(i, j) for i in range(len(codes)) for j in range(i) if groups[i] == groups[j] and int(codes[i] ^ codes[j]).bit_count() <= radius}
    got = [(int(max(p)), int(min(p))) for i, j in hamming.close(codes, groups, radius) for p in zip(i, j, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, None), (401, 400), (401, 400)]
    rng.shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {401: 400}


def test_every_pair_of_a_hot_bucket_meets_once_across_chunks(spark):
    rows = spark.createDataFrame([(0, 7, i, i) for i in range(50)] + [(0, 8, 99, 1)], "t int, bucket bigint, node bigint, code bigint")
    cut = tiles(rows, 8).collect()
    own = {(r.bucket, r.node): r.own for r in cut}
    at = {}
    for r in cut:
        at.setdefault((r.bucket, r.tile), set()).add(r.node)
    assert max(map(len, at.values())) < 50
    for a in range(50):
        for b in range(a):
            together = sum(a in nodes and b in nodes for (bucket, _), nodes in at.items() if bucket == 7)
            assert together >= 1 and (own[7, a] == own[7, b] or together == 1)


def _texts():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(500)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 40, 400]))) for _ in range(60)]
    near = [t.replace(t.split()[0], "OTHER", 1) for t in base[:40]]
    rows = [(i, t) for i, t in enumerate(base + near + base[:10] + [base[0].upper()])]
    return [*rows, (200, None), (201, ""), (202, " \n\t"), (203, "Ä Ö Ü ß"), (203, "Ä Ö Ü ß"), (None, base[5]), (204, "x " * 100_000)]


@pytest.mark.parametrize("tile", [4096, 3])
def test_groups_equal_brute_force(spark, make_docs, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash.links, "__defaults__", (*simhash.links.__defaults__[:2], tile))
    rows = _texts()
    found = simhash.near_duplicates(make_docs(rows)).collect()
    assert len(found) == len(rows)
    prints = {i: brute.fingerprint(t) for i, t in rows if i is not None}
    want = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for r in found:
        if r.doc_id is None:
            assert r.component_id == want[5]
        else:
            assert (r.fp % 2**64, r.component_id) == (prints[r.doc_id], want[r.doc_id])


def test_no_documents(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.drop_near_duplicates(make_docs([])).collect() == []


def test_stage_keeps_one_of_each_group_and_all_columns(make_docs):
    rows = [*_texts(), (300, "only here under this id"), (300, "x " * 100_000), (301, None), (7, _texts()[7][1]), (None, "x " * 100_000)]
    docs = make_docs(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    component = {(r.doc_id, r.fp % 2**64): r.component_id for r in simhash.near_duplicates(docs).collect()}
    want = [(i, t) for i, t in rows if i is None] + sorted({(i, t or "") for i, t in rows if i is not None and component[i, brute.fingerprint(t)] == i})
    assert sorted(map(str, ((r.doc_id, r.text or "") if r.doc_id is not None else (None, r.text) for r in kept.collect()))) == sorted(map(str, want))
    assert (300, "only here under this id") in want and all(i != 301 for i, _ in want)
