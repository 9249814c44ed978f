"""Every registered query with SQL gives the rows of that SQL on the smallest tables."""

import glob
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from corpusloom.plans import catalogue  # noqa: E402


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        src = f if os.path.isfile(f) else f"{f}/*.parquet"
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    return c


def plain(v):
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_against_sql(spark, con, data, name):
    df = catalogue.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in catalogue.SQL:
        assert got
        return
    rel = con.sql(catalogue.SQL[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(plain(v) for v in r) for r in rel.select(", ".join(f'"{c}"' for c in cols)).fetchall()), key=repr)
    assert got == want


def test_fuzzy_titles_against_brute_force(spark, data):
    from corpusloom.functions.text import normalize_title
    from corpusloom.functions.titles import common_subsequence

    t = {r["id"]: r["t"] for r in catalogue._one(spark, data).select("id", normalize_title("title").alias("t")).collect()}
    like = lambda a, b: bool(a and b) and 2 * common_subsequence(a, b) >= 0.85 * (len(a) + len(b))
    want = {i: sum(like(a, b) for j, b in t.items() if j != i) for i, a in t.items()}
    got = {r["id"]: r["links"] for r in catalogue.QUERIES["fuzzy_titles"](spark, data).collect()}
    assert got == want and any(want.values())
