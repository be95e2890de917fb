"""Compare a Spark result with DuckDB's on the same tables."""

import glob
import math
import os

import duckdb


def duck(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{src}'")
    return c


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def same(df, sql, con):
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns), (df.columns, rel.columns)
    a, b = rows(df.columns, [tuple(r) for r in df.collect()]), rows(rel.columns, rel.fetchall())
    assert len(a) == len(b), (len(a), len(b), a[:3], b[:3])
    for x, y in zip(a, b):
        assert x == y, (x, y)
    return len(a)
