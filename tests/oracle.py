"""Compare a query with its SQL, as multisets of rows, columns by name."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def _multiset(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str:
    """Empty if equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _multiset(cursor.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    actual = _multiset([tuple(r) for r in df.collect()], df.columns)
    if actual == expected:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"{actual.total()} rows instead of {expected.total()}; "
        f"{extra.total()} extra such as {list(extra)[:2]}; "
        f"{missing.total()} missing such as {list(missing)[:2]}"
    )
