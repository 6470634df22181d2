"""Each query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from siftline.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return c


def plain(v):
    if hasattr(v, "__len__") and not isinstance(v, str):
        return tuple(map(plain, v))
    return round(float(v), 8) if isinstance(v, float) else v


def rows(df):
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_query_is_its_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    assert entry.entry(spark).columns == ["source_path", "chunk_index", "quality_score", "text"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
