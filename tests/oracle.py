"""Compare a Spark result with the equivalent SQL in DuckDB, values and types."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if v != 0 else 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def spark_rows(df):
    return normal([tuple(r) for r in df.collect()], df.columns), sorted(df.columns)


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return normal(cur.fetchall(), names), sorted(names)


def differences(df, con, sql, show: int = 3) -> str | None:
    """None if equal, else a short description."""
    left, lcols = spark_rows(df)
    right, rcols = sql_rows(con, sql)
    if lcols != rcols:
        return f"columns differ: spark {lcols} sql {rcols}"
    if len(left) != len(right):
        return f"row counts differ: spark {len(left)} sql {len(right)}\n  {left[:show]}\n  {right[:show]}"
    bad = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        text = "\n".join(f"  spark {a}\n  sql   {b}" for a, b in bad[:show])
        return f"{len(bad)} of {len(left)} rows differ, columns {lcols}\n{text}"
    return None
