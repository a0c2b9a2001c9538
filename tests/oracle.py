"""Compare a Spark query with its SQL in DuckDB, row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want, got = rows(names, answer.fetchall()), rows(df.columns, df.collect())
    if want == got:
        return None
    extra, lacking = got - want, want - got
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; "
        f"only spark {list(extra)[:3]}; only sql {list(lacking)[:3]}; columns {sorted(names)}"
    )
