"""Comparison of Spark and DuckDB results."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str | None = None) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    if sf_dir:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9)
    return value


def rows_of(df, columns=None) -> Counter:
    columns = columns or df.columns
    return Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())


def assert_same(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    relation = con.sql(sql)
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    got = rows_of(df, columns)
    assert sum(got.values()) == sum(want.values())
    assert not (got - want) and not (want - got), (list((got - want))[:3], list((want - got))[:3], columns)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
