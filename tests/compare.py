"""Compare a query's rows with those of its SQL answer."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type to the SQL type the answer must have
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(records, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def differences(df, con, sql) -> list[str]:
    """Empty when names, types and rows agree."""
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    want_types = {n: str(d[1]) for n, d in zip(want_names, cursor.description)}
    problems = []
    if sorted(df.columns) != sorted(want_names):
        return [f"columns {sorted(df.columns)} != {sorted(want_names)}"]
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if TYPES.get(kind) != described[name]:
            problems.append(f"type of {name}: {kind} != {described[name]}")
    got = [tuple(r) for r in df.collect()]
    names = sorted(df.columns)
    a = rows_of(got, [df.columns.index(n) for n in names])
    b = rows_of(want, [want_names.index(n) for n in names])
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        problems.append(f"values differ, first: {first}; {sum(x != y for x, y in zip(a, b))} rows")
    return problems
