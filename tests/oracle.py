"""Comparison of a Spark result with a DuckDB result."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(directory):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{directory}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def duckdb_types(relation):
    names = {"VARCHAR": "string", "INTEGER": "int"}
    return {
        c: names.get(str(t), str(t).lower()) for c, t in zip(relation.columns, relation.types)
    }


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def normalized(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cleaned = [
        tuple("NaN" if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order)
        for row in rows
    ]
    return sorted(cleaned, key=_key)
