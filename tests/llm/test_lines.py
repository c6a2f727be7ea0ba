import random

import pytest

from lexmill.llm import lines
from lexmill.operators import scale
from llm import brute


def _rows():
    rng = random.Random(2)
    common = [f"A Line that many documents share, number {i}" for i in range(6)]
    other = ["short", "", "  ", "exactly nineteen cha", "ÄÖÜ exactly twenty c", "ÄÖÜ exactly nineteen", "\tpadded by many blanks, more than once \r"]
    rows = []
    for i in range(150):
        body = [rng.choice([rng.choice(common).upper(), f" {rng.choice(common)}\x0b", rng.choice(other), f"a line of document {i} alone"]) for _ in range(rng.randrange(9))]
        rows.append((i, "\n".join([*body, "The hot line that stands in a third of all"] if i % 3 == 0 else body)))
    rows += [(7, "\n" + common[0] + "\n\n" + common[1]), (7, "\n" + common[0] + "\n\n" + common[1]), (500, None), (501, ""), (502, "\n\n")]
    rows += [(None, common[0] + "\nkept"), (None, common[0]), (None, None), (503, "\n".join(common * 3000)), (504, "no break at all but quite a long line")]
    return rows


def _found(docs):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept").collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_lines_equal_the_plain_version(make_docs, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(scale, "fits_broadcast", lambda *a: False)
    rows = _rows()
    want = sorted((str(i), *rest) for i, *rest in brute.line_dedup(rows))
    assert _found(make_docs(rows).repartition(5)) == want and sum(r[2] for r in want) > 100


def test_rows_of_one_document_count_once(make_docs):
    line = "the very same line of text, long enough"
    assert [r[2] for r in _found(make_docs([(1, line), (1, line + "\n"), (2, line), (None, line)]))] == [0] * 4
    assert [r[2] for r in _found(make_docs([(1, line), (1, line + "\n"), (2, line), (3, line)]))] == [1, 1, 1, 0]


def test_columns_stay_and_empty_tables_pass(make_docs):
    docs = make_docs([])
    empty = lines.drop_common_lines(docs.withColumn("row", docs.doc_id).withColumn("places", docs.text).withColumn("n_lines", docs.text))
    assert empty.collect() == [] and empty.columns == [*[c for c in docs.columns if c != "kept"], "row", "places", "n_lines", "n_dropped", "kept"]


def test_no_python_worker(make_docs):
    plan = lines.drop_common_lines(make_docs(_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
