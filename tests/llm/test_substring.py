import hashlib
import random

from pyspark.sql import functions as F

from lexmill.llm import substring
from llm import brute


def _texts(seed=1, n=80):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = rng.choices(vocabulary, k=600)
    rows = []
    for i in range(n):
        w = []
        while len(w) < rng.choice([0, 5, 19, 20, 60, 200]):
            if rng.random() < 0.6:
                at = rng.randrange(570)
                w += base[at : at + rng.randrange(5, 70)]
            else:
                w += rng.choices(vocabulary, k=rng.randrange(1, 15))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    return [*rows, (90, "x " * 100), (91, "x " * 30), (92, None), (93, ""), (94, " \n"), (95, " ".join(base * 30)), (96, rows[0][1].upper()), (97, "p q r s t " * 5), (98, " ".join(f"o{i % 17}" for i in range(45))), (99, "u v " * 11)]


def _result(df):
    rows = df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept")).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}


def test_equals_brute_force_in_any_layout(make_docs):
    for seed in (1, 2):
        rows = _texts(seed)
        want = brute.repeated(dict(rows))
        for parts in (1, 7):
            assert _result(substring.remove_repeats(make_docs(rows).repartition(parts))) == want


def test_settling_in_small_pieces_changes_nothing(make_docs, monkeypatch):
    rows = _texts(3)
    monkeypatch.setattr(substring, "HELD", 50)
    held = [b for b in substring._parse(iter(make_docs(rows).select("doc_id", "text").where("doc_id is not null").toArrow().to_batches(5)))]
    assert len(held) > 10
    assert _result(substring.remove_repeats(make_docs(rows))) == brute.repeated(dict(rows))


def test_null_and_repeated_keys_and_no_documents(make_docs):
    text = " ".join(f"a{i}" for i in range(30))
    found = substring.remove_repeats(make_docs([(1, text), (1, text), (None, text), (None, text), (2, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (0, 0), (1, 0), (1, 30), (2, 30)]
    assert substring.remove_repeats(make_docs([])).collect() == []


def test_cut_leaves_clean_texts_as_they_are(make_docs):
    text = "\n".join(f"a{i}" for i in range(30))
    docs = make_docs([(1, text), (2, f"own  words\n{text}\nend"), (3, None)])
    found = {r.doc_id: r for r in substring.cut(docs).collect()}
    assert substring.cut(docs).columns == docs.columns
    assert (found[1].text, found[2].text, found[3].text) == (text, "own words end", None)
    assert found[2].n_chars == len("own words end") and found[1].kept == 1
    assert hashlib.sha256(b"").hexdigest() == brute.repeated({1: ""})[1][2]


def test_rows_of_one_id_are_judged_apart(make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (2, a), (2, b), (3, a + " " + b), (3, b), (3, None), (None, a), (4, "short"), (4, "short")]
    found = substring.remove_repeats(make_docs(rows).repartition(3))
    got = sorted((str(r.doc_id), r.text or "", r.n_words, r.n_removed, r.kept) for r in found.collect())
    want = [(1, a, 60, 0, a), (2, a, 60, 60, ""), (2, b, 60, 0, b), (3, a + " " + b, 120, 120, ""), (3, b, 60, 60, ""), (3, "", 0, 0, ""), (None, a, 60, 0, a), (4, "short", 1, 0, "short"), (4, "short", 1, 0, "short")]
    assert got == sorted((str(i), *rest) for i, *rest in want)
    twice = substring.remove_repeats(make_docs([(7, a), (7, a)])).collect()
    assert sorted(r.n_removed for r in twice) == [0, 60]
