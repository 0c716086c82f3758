"""Runs a registered query and its SQL and compares rows, columns and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(flat, key=lambda r: tuple((x is None, type(x).__name__, x) for x in r))


def compare(spark, con, sf_dir, name, query, sql) -> tuple[str, int]:
    """Empty text when both agree, else what differs; and the number of rows."""
    df = query(spark, sf_dir)
    ours = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(ours)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}", len(ours)
    types = dict(zip(names, [str(d[1]) for d in cursor.description]))
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if kinds.get(kind) != types[column]:
            return f"type of {column}: {kind} vs {types[column]}", len(ours)
    a, b = _sorted_rows(df.columns, ours), _sorted_rows(names, theirs)
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        return f"{len(different)} rows differ, first {different[0]}", len(ours)
    return "", len(ours)
