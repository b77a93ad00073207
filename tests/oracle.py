"""Run a registered query on Spark and its SQL on DuckDB and compare whole results."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if (Path(folder) / f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda r: tuple((v is None, type(v).__name__, repr(v)) for v in r)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=key)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    names = df.columns
    ours = _rows(names, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    their_names = [d[0] for d in cur.description]
    theirs = _rows(their_names, cur.fetchall())
    if sorted(names) != sorted(their_names):
        return f"columns {sorted(names)} and {sorted(their_names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    if not ours:
        return "no rows"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} and {b}"
    return None
