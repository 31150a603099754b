"""Compare a query's result with DuckDB on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (int, bool)) or v is None or isinstance(v, str):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None when columns and rows agree, else a short account of what differs."""
    cols, got = spark_rows(df)
    want_cols, want = duck_rows(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got == want:
        return None
    extra, lacking = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only ours {list(extra)[:3]}; only theirs {list(lacking)[:3]}"
    )
