"""Every registered query with SQL must equal its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

# long iterative runs get their own smaller tests
SLOW = {"mf_train", "mf_cross_validate", "logistic_train_steps"}
NAMES = sorted(n for n in E.oracle_sql() if n not in SLOW)


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    compare(E.queries()[name](spark, sf), con, E.oracle_sql()[name])


def test_every_query_is_registered_with_a_callable():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E.BASE_ORACLE) == set(E.BASE_QUERIES) <= set(q)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["term", "tfidf"]
