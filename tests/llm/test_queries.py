"""The queries over the smallest tables: against SQL where there is any, else against plain versions."""

import hashlib

import numpy as np
import pytest
import zlib

import __spark_entry__ as entry
from checks.compare import connect, difference
from lexmill.llm import oracle, queries
from llm import brute


@pytest.fixture(scope="module")
def tables(small):
    con = connect(small)
    return con, con.execute("SELECT doc_id, text, lang FROM documents").fetchall(), con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()


@pytest.mark.parametrize("name", oracle.SQL)
def test_query_equals_its_sql(spark, small, tables, name):
    assert difference(queries.QUERIES[name](spark, small).toPandas(), tables[0].execute(oracle.SQL[name]).df()) is None


@pytest.mark.parametrize("name", oracle.VARIANTS)
def test_a_variant_equals_its_sql(spark, small, tables, name):
    assert difference(entry.queries()[name](spark, small).toPandas(), tables[0].execute(entry.oracle_sql()[name]).df()) is None


def test_each_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(oracle.SQL) <= set(entry.oracle_sql())


def test_simhash_whole_table(spark, small, tables):
    prints = {i: brute.fingerprint(t) for i, t, _ in tables[1]}
    root = brute.components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash"](spark, small).collect()}
    assert found == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}


def test_embedding_dedup_whole_table(spark, small, tables):
    ids, x = np.array([i for i, _ in tables[2]]), np.array([v for _, v in tables[2]], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = dict(zip(ids.tolist(), ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist(), strict=True))
    found = {r.vec_id: r.n_links for r in queries.QUERIES["op2_embedding_dedup"](spark, small).collect()}
    assert sum(found.values()) >= 0.98 * sum(links.values()) and all(found[i] <= n for i, n in links.items())


def test_nearest_whole_table(spark, small, tables):
    vectors = {i: np.asarray(v, float) for i, v in tables[2]}
    hits = total = 0
    found = {}
    for r in queries.QUERIES["op4_nearest"](spark, small).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q in (i for i in vectors if i % 20 == 0):
        want = sorted((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:20]
        hits, total = hits + len({i for _, i in want} & found[q]), total + len(want)
    assert hits >= 0.9 * total


def test_language_and_quality_held_out(spark, small, tables):
    lang = {i: la for i, _, la in tables[1]}
    found = queries.QUERIES["op3_language_id"](spark, small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    quality = dict(tables[0].execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in queries.QUERIES["op9_quality"](spark, small).collect() if r.held_out and r.doc_id in quality]
    assert held and sum(r.predicted == quality[r.doc_id] for r in held) >= 0.9 * len(held)


def test_tokens_come_back(spark, small, tables):
    texts = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t, _ in tables[1]}
    assert {r.doc_id: r.decoded_sha256 for r in queries.QUERIES["op7_byte_bpe"](spark, small).collect()} == texts
