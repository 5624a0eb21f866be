"""Every registered query against the same query in SQL on the same tables."""

import pytest

import oracle
from hiretide.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if not q.sql] == []


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name].run(spark, SF)
    assert oracle.difference(df, con, QUERIES[name].sql) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(entry.oracle_sql())
