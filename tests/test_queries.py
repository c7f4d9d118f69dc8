"""Every query against its SQL on the smallest tables (``CHECK_SF_DIR`` for others)."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    rows = sorted(map(tuple, frame.itertuples(index=False)), key=repr)
    return pd.DataFrame(rows, columns=frame.columns)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, database, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name not in oracle_sql():
        return
    want = database.execute(oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = normal(got), normal(want)
    assert len(got) == len(want)
    differing = (got.astype(str) != want.astype(str)).any(axis=1)
    assert not differing.any(), f"\n{got[differing].head()}\n{want[differing].head()}"


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
