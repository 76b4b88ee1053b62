"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from docsift.plans import queries as registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def comparable(frame):
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else str(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, v or "") for v in row))


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registered.QUERIES) <= set(entry.queries()) and set(registered.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
