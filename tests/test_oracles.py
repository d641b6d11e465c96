"""Every query that has SQL gives what DuckDB gives on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from corpusloom.queries import oracle_sql, queries

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{round(v, 5) + 0.0:.5f}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = queries()[name](spark, str(DATA))
    cur = duck.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_runs(spark, name):
    assert queries()[name](spark, str(DATA)).count() >= 0
