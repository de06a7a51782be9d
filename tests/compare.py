"""Rows of a query against rows of its SQL, as multisets."""

import collections
import decimal
import math
import os

import duckdb


def value(x):
    if x is None or isinstance(x, (bool, str, bytes)):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, int):
        return float(x) if abs(x) < 2**53 else x
    if isinstance(x, (list, tuple)):
        return tuple(map(value, x))
    return x


def connection(folder):
    c = duckdb.connect()
    for p in os.listdir(folder):
        c.execute(f"create view {p.split('.')[0]} as select * from read_parquet('{folder}/{p}')")
    return c


def difference(df, con, sql):
    cols = sorted(df.columns)
    rows = collections.Counter(repr(tuple(value(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(sql)
    names = list(rel.columns)
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = collections.Counter(repr(tuple(value(r[i]) for i in at)) for r in rel.fetchall())
    return rows - want, want - rows
