"""Queries with SQL give its rows on the smallest tables."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from corpusloom.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        src = f if os.path.isfile(f) else f"{f}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    df = queries.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    assert got == sorted(con.sql(queries.SQL[name]).select(", ".join(cols)).fetchall())
