"""Runs a registered query and its SQL and compares them value by value."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat(timespec="microseconds"))
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, float):
        return ("float", repr(value))
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, list]:
    """Row count, and up to five rows that only one side has."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    want = _bag(names, cursor.fetchall())
    got = _bag(df.columns, df.collect())
    odd = [("spark", r) for r in (got - want)][:5] + [("sql", r) for r in (want - got)][:5]
    return sum(got.values()), odd
