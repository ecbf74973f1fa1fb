"""Compare a Spark result with the result of SQL in DuckDB, as bags of rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), _bag(df.columns, [tuple(row) for row in df.collect()])


def sql_bag(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), _bag(names, cursor.fetchall())
