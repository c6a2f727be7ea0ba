import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, component_id string, kept int, _key int, key string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns whose names clash with results."""

    def make(rows):
        full = [(*r, *("en", "a")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(i, t, la, s, len(t or ""), "s", "c", 1, 2, "k") for i, t, la, s in full], DOCS)

    return make
