"""Compares a query with its SQL in DuckDB, as the driver does."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter

import duckdb


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    return con


def compare(spark, folder: str, query, sql: str) -> None:
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect())
    res = connect(folder).execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(norm(r[i]) for i in at) for r in res.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
