"""Rows of a query and of its SQL, made comparable."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.sql(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if hasattr(x, "isoformat"):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows_of(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def assert_same(df, con, sql):
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(found.columns, found.fetchall())
