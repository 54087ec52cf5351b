"""Runs a query and its SQL side by side and compares rows as bags."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(float(v)) if isinstance(v, Decimal) else repr(v)


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    return con


def same(spark, con, folder, query, sql) -> tuple[list, list]:
    df = query(spark, folder)
    names = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in names) for r in df.collect())
    r = con.sql(sql)
    assert sorted(r.columns) == names
    at = [r.columns.index(c) for c in names]
    return got, sorted(tuple(_plain(x[i]) for i in at) for x in r.fetchall())
