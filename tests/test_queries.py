"""Every trajectory query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from wakeline.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def plain(frame):
    def cell(v):
        if v is None or pd.isna(v):
            return ""
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            try:
                return repr(round(float(v), 6)) if not isinstance(v, (bool, str)) else str(v)
            except (TypeError, ValueError):
                return str(v)
        return repr(round(float(v), 6))

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
