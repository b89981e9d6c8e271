"""Every query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_query_has_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    if name == "model_roundtrip":
        assert df.filter("kept <> restored").isEmpty()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "sentiment" in df.columns


def test_all_scores_occur(spark):
    got = QUERIES["sentiment_lexicon"](spark, FOLDER).select("sentiment").distinct().collect()
    assert {x[0] for x in got} == {-1, 0, 1}
