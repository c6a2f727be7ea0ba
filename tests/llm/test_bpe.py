import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lexmill.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other(vocabulary):
    ranks = {t: i for i, t in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def test_every_token_has_a_slot_of_its_own(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    assert [encoder.lookup(t) for t in vocabulary.tokens] == list(range(len(vocabulary.tokens)))
    assert sorted(vocabulary.slots.tolist()) == list(range(len(vocabulary.tokens)))
    assert encoder.lookup(b"no such token at all") == -1


def test_ids_equal_the_library_and_bytes_come_back(make_docs, vocabulary, other):
    rng = random.Random(7)
    alphabet = list("abcdefghijklmnopqrstuvwxyz   \n\t0123456789'’.,!?ßéñ漢字🙂́<|endoftext|>")
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randrange(200)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "a" * 20_000), (903, "<|endoftext|>"), (904, " " * 500), (None, "no key"), (905, "twice"), (905, "twice")]
    found = bpe.decode(bpe.encode(make_docs(rows), vocabulary), vocabulary).collect()
    assert sorted(((r.doc_id or -1), r.ids) for r in found) == sorted(((i or -1), other.encode_ordinary(t or "")) for i, t in rows)
    texts = {i: (t or "").encode() for i, t in rows}
    assert all(bytes(r.decoded) == texts[r.doc_id] for r in found)
    assert bpe.encode(make_docs([]), vocabulary).collect() == []


def test_a_full_memory_changes_nothing(vocabulary, other, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    encoder = bpe.Encoder(vocabulary)
    text = "Zebras quuxing zzyzx quuxing again; zebras zzyzxing."
    assert encoder.encode(text) == other.encode_ordinary(text) and len(encoder) <= 3 and len(encoder.older) <= 3


def test_bad_input(spark, vocabulary, tmp_path):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [60_000])], "doc_id bigint, ids array<int>"), vocabulary).collect()
    path = tmp_path / "few"
    path.write_bytes(b"YQ== 0\nYQ== 1\n")
    with pytest.raises(ValueError, match="each token once"):
        bpe.load(str(path), ".")


def test_spaces_of_any_kind(vocabulary, other):
    rng = random.Random(9)
    encoder = bpe.Encoder(vocabulary)
    alphabet = [*"ab1.'éñ漢\n\t\r\x1c\x85\xa0\u2003\u200b", " ", " ", " ", "'s", " the", "  "]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(25)))
        assert encoder.encode(text) == other.encode_ordinary(text), repr(text)


def test_digests_are_of_ids_and_bytes(make_docs, vocabulary, other):
    rows = [(1, "some words, and more"), (1, "some words, and more"), (2, None), (3, ""), (None, " no  key "), (4, "x" * 100_000), (5, "long text " * 200_000)]
    found = bpe.digests(make_docs(rows), vocabulary).collect()
    ids = {i: other.encode_ordinary(t or "") for i, t in rows}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids[i]), sha(" ".join(map(str, ids[i])).encode()), sha((t or "").encode())) for i, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert bpe.digests(make_docs([]), vocabulary).collect() == []


def test_ids_of_the_whole_table(spark, small, vocabulary, other):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = {r.doc_id: r.ids for r in bpe.encode(docs, vocabulary).collect()}
    assert found == {r.doc_id: other.encode_ordinary(r.text or "") for r in docs.select("doc_id", "text").collect()}
