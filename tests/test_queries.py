"""Every query of the engine against its DuckDB equivalent, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from lumenfold import catalog

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


@pytest.fixture(scope="module")
def duck() -> duckdb.DuckDBPyConnection:
    found = duckdb.connect()
    for f in os.listdir(DATA):
        found.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in row) for row in df.select(*columns).collect()), key=str)
    if name not in SQL:
        assert df.columns
        return
    found = duck.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall()), key=str)
    assert got == want
