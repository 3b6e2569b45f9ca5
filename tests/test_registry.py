"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from scripts.oracle_check import TABLES, rows_of
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "trip_count" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    if key not in ORACLE:
        assert sdf.columns
        return
    res = duck.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
