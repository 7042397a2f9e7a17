"""Every registered query against its oracle on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return ""
        if hasattr(x, "item"):
            x = x.item()
        return f"{x:.4f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(plain(x) for x in row) for row in ordered.itertuples(index=False))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 8
