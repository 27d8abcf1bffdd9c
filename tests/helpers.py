"""Comparison of Spark results with SQL on the same parquet tables."""

import glob
import math
import os

import duckdb


def connect(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v)


def same_rows(df, con, sql):
    rows, cols = df.collect(), df.columns
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(cols) == sorted(names)
    mine = sorted(tuple(plain(r[c]) for c in sorted(cols)) for r in rows)
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in sorted(cols)) for r in result.fetchall())
    assert mine == theirs
