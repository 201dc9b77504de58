"""Compare a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.UTC).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def rows(columns: list[str], data) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    cur = con.execute(sql)
    want_cols, want = rows([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = rows(df.columns, df.collect())
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}"
    if want == got:
        return None
    lost, extra = want - got, got - want
    return (
        f"{sum(got.values())} rows vs {sum(want.values())}; {sum(lost.values())} missing, {sum(extra.values())} extra;\n"
        f"  want {sorted(lost, key=repr)[:3]}\n  got  {sorted(extra, key=repr)[:3]}"
    )
