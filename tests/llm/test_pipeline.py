"""The pipeline's stages against plain versions, each on its own input."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import bpe, quality
from llm import brute


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def test_columns_stay_and_rows_only_go_where_they_may(steps):
    assert all(s.dtypes == steps[0].dtypes for s in steps[:5])
    counts = [s.count() for s in steps]
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[4] == counts[5]


def test_quality_rejects_what_scores_low(spark, small, steps):
    model = quality.fit(steps[0], spark.read.parquet(f"{small}/labels.parquet"))
    want = {r.doc_id for r in quality.score(steps[0], model).where(F.col("score") >= 0.7).collect()}
    assert {r.doc_id for r in steps[1].collect()} == want


def test_near_copies_go_and_others_stay(steps):
    prints = {r.doc_id: brute.fingerprint(r.text) for r in steps[1].collect()}
    root = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(i for i in prints if root[i] == i)


def test_repeats_are_cut(steps):
    before, after = ({r.doc_id: r for r in s.collect()} for s in steps[2:4])
    for key, (_, gone, digest) in brute.repeated({i: r.text for i, r in before.items()}).items():
        if gone:
            assert hashlib.sha256(after[key].text.encode()).hexdigest() == digest
        else:
            assert after[key] == before[key]


def test_mix_follows_the_targets(steps):
    before, after = steps[3].collect(), Counter(r.doc_id for r in steps[4].collect())
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        n = len(brute.words(r.text))
        sizes[r.source] += n
        taken[r.source] += n * after[r.doc_id]
        largest[r.source] = max(largest[r.source], n)
    want = brute.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in sizes) and max(after.values()) <= 2


def test_tokens_equal_the_library(steps):
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks={t: i for i, t in enumerate(vocabulary.tokens)}, special_tokens={})

    def digest(b):
        return hashlib.sha256(b).hexdigest()

    want = Counter()
    for r in steps[4].collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id, r.source, len(ids), digest(" ".join(map(str, ids)).encode()), digest((r.text or "").encode())] += 1
    assert Counter(tuple(r) for r in steps[5].collect()) == want


def test_run_is_all_stages(spark, small, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, steps[5].collect()))
