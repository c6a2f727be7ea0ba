from collections import defaultdict

import pytest

from lexmill.llm import mixing
from llm import brute


def _rows(n=600):
    sources = ["b", "a", "c", None, "", "hot", "Ä", "z"]
    return [(i, " ".join(["w"] * ((i * 37) % 90)), "en", "hot" if i % 3 == 0 else sources[i % 8]) for i in range(n)]


def test_targets_and_taken_words(make_docs):
    rows = _rows()
    sizes = defaultdict(int)
    for i, t, _, s in rows:
        sizes[s] += len(t.split())
    want, source = brute.targets(sizes), {i: s for i, _, _, s in rows}
    found = mixing.copies(make_docs(rows)).collect()
    taken, size = defaultdict(int), {i: len(t.split()) for i, t, _, _ in rows}
    assert len(found) == len(rows)
    for r in found:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[s]) and r.target == pytest.approx(want[s])
        assert 0 <= r.copies <= 2
        taken[s] += r.copies * r["size"]
    assert all(abs(taken[s] - want[s]) <= 180 for s in sizes)


def test_reruns_and_layouts_agree(make_docs):
    docs = make_docs(_rows())
    first, second = (sorted(map(tuple, mixing.copies(d).collect())) for d in (docs.repartition(1), docs.repartition(9)))
    assert first == second


def test_mix_has_whole_rows_as_often_as_said(make_docs):
    docs = make_docs([*_rows(90), (7000, None, "en", "b"), (None, "no key here", "en", "b"), (7001, "twice over", "en", "a"), (7001, "twice over", "en", "a")])
    mixed, copies = mixing.mix(docs), mixing.copies(docs)
    assert mixed.columns == docs.columns
    want, got = defaultdict(int), defaultdict(int)
    for r in copies.collect():
        want[r.doc_id] += r.copies
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert all(got[i] == n for i, n in want.items() if i != 7001) and got[7001] in (0, 2, 4)


def test_empty_inputs(make_docs):
    assert mixing.copies(make_docs([])).collect() == []
    found = mixing.copies(make_docs([(1, None), (2, ""), (3, " ")])).collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.copies) for r in found) == [(i, 0, 0, 0.0, 0) for i in (1, 2, 3)]


def test_rows_without_a_key_keep_their_copies(make_docs):
    rows = [(None if i % 3 == 0 else i, f"own{i} " + t, la, s) for i, t, la, s in _rows(300)] + [(None, "the same", "en", "b")] * 5
    docs = make_docs(rows)
    want, got = defaultdict(int), defaultdict(int)
    for r in mixing.copies(docs).collect():
        want[r.doc_id, r["size"], r.source_size] += r.copies
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    for r in mixing.mix(docs).collect():
        got[r.doc_id, len(r.text.split()), sizes[r.source]] += 1
    assert got == {k: n for k, n in want.items() if n} and any(k[0] is None for k in got)
