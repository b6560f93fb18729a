"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER"}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, frame, sql: str) -> str | None:
    """None if both sides agree, else a short description of the difference."""
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = [(c, t, types.get(c)) for c, t in frame.dtypes if SPARK_TO_DUCK.get(t) != types.get(c)]
    if wrong:
        return f"types differ: {wrong}"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns differ: {sorted(frame.columns)} / {sorted(names)}"
    found = rows_of(frame.columns, frame.collect())
    if found == expected:
        return None
    extra = [r for r in found if r not in set(expected)][:2] if len(found) < 200_000 else []
    missing = [r for r in expected if r not in set(found)][:2] if len(found) < 200_000 else []
    return f"{len(found)} rows / {len(expected)} expected; only here: {extra}; only there: {missing}"
