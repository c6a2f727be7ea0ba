"""The queries against their SQL at the smallest scale; ``python -m checks.compare`` runs all at any scale."""

import pytest

import __spark_entry__ as entry
from checks import oracle, registry
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_its_sql(spark, duck, small, name):
    ours = entry.queries()[name](spark, small).toPandas()
    assert len(ours) > 0
    assert difference(ours, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_every_sql_has_a_query_and_few_queries_have_none():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) == set(oracle.oracle_sql())


def test_flagship(spark):
    rows = entry.entry(spark).groupBy("cls").count().collect()
    assert {r.cls: r["count"] for r in rows}.keys() == {"neg", "pos"}
