"""Every registered query against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
            v = v.tolist() if hasattr(v, "tolist") else v
            if isinstance(v, (list, tuple)):
                return str([float(x) for x in v])
        if pd.isna(v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v))
        return str(v)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys() and oracle_sql().items() >= ORACLES.items() and queries().items() >= QUERIES.items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ours = queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry(spark).count() > 0
