import re

import pytest
from compare import connect, spark_rows, sql_rows
from conftest import SMALL

import __spark_entry__ as registered

QUERIES = registered.queries()
ORACLE = registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


#: Queries of the corpus operators have tests of their own.
OWN = [name for name in QUERIES if name != "pipeline" and not re.match(r"op\d+_", name)]


def test_every_query_has_sql():
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    names, expected = sql_rows(con, ORACLE[name])
    assert sorted(df.columns) == sorted(names)
    got = spark_rows(df)
    assert sum(got.values()) > 0
    assert got == expected


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["review_id", "sentiment", "predicted_sentiment", "prediction"]
    assert df.count() > 0
