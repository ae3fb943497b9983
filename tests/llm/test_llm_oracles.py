"""Operators that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from tokoledger.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, small_sf, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_sf}/{table}.parquet'")
    want = db.execute(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, small_sf)
    columns = sorted(got.columns)
    assert columns == sorted(c[0] for c in want.description)
    place = [[c[0] for c in want.description].index(c) for c in columns]
    expected = sorted(tuple(str(row[k]) for k in place) for row in want.fetchall())
    found = sorted(tuple(map(str, row)) for row in got.select(*columns).collect())
    assert found and found == expected
