"""Comparison of a query with its SQL twin, order of rows and columns aside."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _by_name(columns):
    return sorted(range(len(columns)), key=lambda i: columns[i])


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    twin = con.execute(sql)
    names = [d[0] for d in twin.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _bag(twin.fetchall(), _by_name(names))
    got = _bag([tuple(r) for r in df.collect()], _by_name(df.columns))
    if want == got:
        return None
    extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"rows {sum(got.values())} against {sum(want.values())}; extra {extra}; missing {missing}"
