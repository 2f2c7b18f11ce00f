"""Every query of the library against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from textloom.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{DIR}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NA or v != v:
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (float, np.floating)):
        return int(v) if float(v).is_integer() and abs(v) < 1e15 else float(f"{v:.9g}")
    return int(v) if isinstance(v, np.integer) else v


def canonical(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in row) for row in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DIR).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) and len(got)  # what it holds is tested by brute force elsewhere
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = canonical(got), canonical(want)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert len(x) == len(y)
        for u, v in zip(x, y, strict=True):
            assert u == v or isinstance(u, float) and isinstance(v, (int, float)) and math.isclose(u, v, rel_tol=1e-7), (name, x, y)
