"""Every query with SQL against DuckDB, on the smallest tables."""

import glob
import os
import re

import duckdb
import pytest

from lapwing import plans, registry

SF = "/root/testdata/sf0.001"
plans.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def _cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, float):
        return round(x, 6) + 0.0
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_cell(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cursor = duck.execute(registry.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(columns, cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert len(df.columns) == len(set(df.columns))
    df.collect()


def test_names():
    assert all(re.fullmatch(r"[a-z]+[a-z0-9_]*", n) for n in registry.QUERIES)
