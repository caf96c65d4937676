"""Runs registered queries next to their SQL and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, math.inf if math.isnan(value) else value)
    if isinstance(value, (bool, int)):
        return (1, value)
    return (2, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda r: [_key(v) for v in r])


def compare(spark_df, con, sql: str):
    """None if equal, else a short description of the difference."""
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None
