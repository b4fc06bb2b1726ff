"""Compare a registered query with its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return f"{type(v).__name__}:{v}"


def rows_of(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in place) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    res = con.execute(sql)
    return rows_of([d[0] for d in res.description], res.fetchall())


def difference(got, want, limit=5):
    """None when equal, else a short description."""
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got[1] == want[1]:
        return None
    a, b = set(got[1]), set(want[1])
    return (f"{len(got[1])} rows / {len(want[1])} rows; only Spark {sorted(a - b)[:limit]}; "
            f"only SQL {sorted(b - a)[:limit]}")
