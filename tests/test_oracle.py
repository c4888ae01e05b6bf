"""Every registered query equals its DuckDB SQL twin (the driver's gate), at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from martlane.catalog import QUERIES as SHOP_QUERIES
from oracle_check import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    # trained models and tokenizers of the training-data queries are not SQL
    assert set(SHOP_QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_SMALL)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert len(out) == 24 and df.columns == ["date", "hour", "today", "yesterday"]
