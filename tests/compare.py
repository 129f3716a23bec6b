"""Run queries in Spark and in DuckDB and compare whole results."""

from __future__ import annotations

from collections import Counter

import duckdb

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def as_bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    found = as_bag([tuple(r) for r in df.collect()], df.columns)
    wanted = as_bag(expected, columns)
    assert found == wanted, (list((found - wanted).items())[:3], list((wanted - found).items())[:3])
    return len(expected)
