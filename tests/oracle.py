"""Compares a registered query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.9g}"))
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, str, bytes)):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    try:
        return float(v)
    except (TypeError, ValueError):
        return str(v)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if equal."""
    df = query(spark, sf_dir)
    mine = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows_of(df.columns, [tuple(r) for r in mine]), rows_of(names, cur.fetchall())
    if a == b:
        return ""
    return f"{sum(a.values())} and {sum(b.values())} rows; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
