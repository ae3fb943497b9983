"""Every registered query agrees with its DuckDB oracle (columns, types, rows,
values) on the smallest test data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck_connection
from tokoledger.catalog import builders

QUERIES = {name: q for name, q in entry.queries().items() if name in builders()}
ORACLES = {name: q for name, q in entry.oracle_sql().items() if name in builders()}


@pytest.fixture(scope="module")
def duck(small_sf):
    return duck_connection(small_sf)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, small_sf, duck, name):
    res = compare(spark, name, QUERIES[name], ORACLES[name], small_sf, duck)
    assert res["status"] == "ok", res.get("problems")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "Aktual_Point" in df.columns
