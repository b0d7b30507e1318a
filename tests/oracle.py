"""Rows of a query and of its SQL, made comparable."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    return con


def text(x):
    if x is None or x != x:
        return "null"
    if hasattr(x, "tolist") and getattr(x, "ndim", 0) or isinstance(x, (list, tuple)):
        return str([text(y) for y in x])
    if isinstance(x, str):
        return x
    return f"{float(x):.9g}"


def rows(df):
    return sorted(tuple(text(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))
