import hashlib
import random

import public_tokenizers as files_of
import pytest
import sentencepiece
import tokenizers

from lexmill.llm import alignment, queries
from llm import brute

JSON, MODEL = files_of.path("byte_bpe_50k.json"), files_of.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def files():
    return alignment.load(JSON, MODEL, files_of.PATTERN)


@pytest.fixture(scope="module")
def spell(files):
    whole, pieces = tokenizers.Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    whole.encode_special_tokens = True
    return (
        lambda t: [(i, files.bytes_a[i]) for i in whole.encode(" " + t, add_special_tokens=False).ids],
        lambda t: [(i, files.bytes_b[i]) for i in pieces.encode(t)],
    )


def _texts(n):
    rng = random.Random(11)
    alphabet = [*"abcdefghijklmnopqrstuvwxyz     \n\t0123456789'’.,!?ßéñ漢字🙂́\x1c\x85\xa0\x00", "<|endoftext|>", "<s>", "<0x0A>", "'s", " the", " and", "   ", " \n "]
    return ["".join(rng.choices(alphabet, k=rng.randrange(50))) for _ in range(n)]


def test_words_apart_equal_whole_texts(files):
    pair, whole = alignment.Pair(files), alignment.Pair(files)
    assert pair.by_word
    whole.by_word = False
    texts = [*_texts(3000), "a", " a", "a ", "a  b", "a \nb", "a\n b", "x" * 3000 + " y"]
    assert [x.to_pylist() for x in pair.align(texts)] == [x.to_pylist() for x in whole.align(texts)]


def test_digest_equals_the_plain_version(make_docs, files, spell):
    texts = [*_texts(200), None, "", " ", "a▁b", "the same text", "the same text", "word " * 4000, "x" * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no key"), (3, "a key again")]
    plain = brute.alignment([t if t is None or len(t) < 5000 else "" for _, t in rows], *spell)
    docs = make_docs([(i, t if t is None or len(t) < 5000 else "") for i, t in rows])
    found = alignment.link(docs.repartition(4), files).collect()
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in found]
    sha = [hashlib.sha256(p[-1].encode()).hexdigest() if p[-1] else "" for p in plain]
    assert sorted(map(str, got)) == sorted(str((i, *p[:-1], h)) for (i, _), p, h in zip(rows, plain, sha, strict=True))
    assert len(set(sha)) > 100 and "" in sha
    long = alignment.align(make_docs(rows), files).where("length(text) >= 5000").collect()
    for r in long:
        a, b = (s(r.text) for s in spell)
        assert r.ids_a == [i for i, _ in a] and r.ids_b == [i for i, _ in b] and sum(r.sizes_a) == len(a) and sum(r.sizes_b) == len(b)
    assert len(long) == 2
    assert alignment.link(make_docs([]), files).collect() == []


def test_a_full_memory_changes_nothing(files, monkeypatch):
    pair, texts = alignment.Pair(files), [f"{t} one two three one two" for t in _texts(60)]
    want = [x.to_pylist() for x in pair.align(texts)]
    monkeypatch.setattr(alignment, "CACHE", 2)
    monkeypatch.setattr(alignment, "CALL", 10)
    small = alignment.Pair(files)
    parts = [[x.to_pylist() for x in small.align(texts[i : i + 7])] for i in range(0, 60, 7)]
    assert [sum((p[k] for p in parts), []) for k in range(4)] == want and small.total < 500


def test_pairs_are_bounded_by_the_vocabularies(spark, small, files):
    found = alignment.linked(spark.read.parquet(f"{small}/documents.parquet"), files)
    counted = alignment.pair_counts(found, files).collect()
    for r in counted:
        a, b = files.bytes_a[r.a], files.bytes_b[r.b]
        assert a.endswith(b) or b.endswith(a)


def test_query_equals_the_plain_version(spark, small, spell):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op13_alignment"](spark, small).collect()}
    assert len(found) == len(docs)
    counts = {}
    spelled = {i: tuple(s(t) if t else [] for s in spell) for i, t in docs}
    links = {}
    for i, (a, b) in spelled.items():
        ends, at = [], {}
        for s in (a, b):
            total, e = 0, {}
            for x, w in s:
                total += len(w)
                e[total] = x
            ends.append(e)
        links[i] = [(ends[0][e], ends[1][e]) for e in ends[0] if e in ends[1]]
        for x in links[i]:
            counts[x] = counts.get(x, 0) + 1
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    for i, (a, b) in spelled.items():
        r = found[i]
        assert (r.n_a, r.n_b, r.n_links) == (len(a), len(b), len(links[i]))
        assert r.count_sum == sum(counts[x] for x in links[i]) and r.n_best == sum(counts[x] == top[x[1]] for x in links[i])
    short = [(i, t) for i, t in docs if len(t or "") < 2000]
    for (i, _), p in zip(short, brute.alignment([t for _, t in short], *spell), strict=True):
        assert found[i].groups_sha256 == (hashlib.sha256(p[-1].encode()).hexdigest() if p[2] else "")
