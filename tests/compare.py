"""Running a query's SQL in DuckDB and comparing rows whatever their order."""

import os

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sql, folder):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        c.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return c.execute(sql).df()


def _plain(x):
    if isinstance(x, (list, tuple, np.ndarray)):
        return tuple(_plain(y) for y in x)
    if x is None or x is pd.NA or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (int, float, np.number)):
        return round(float(x), 6) + 0.0
    return x


def rows(df):
    cols = sorted(df.columns)
    return sorted(repr([_plain(v) for v in r]) for r in df[cols].itertuples(index=False, name=None))


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
