"""Compare a query with its SQL twin: columns by name, rows as a bag of values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("number", format(value, "f"))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in rows)


def differences(frame, con, sql: str) -> str | None:
    """None if both agree, else a short description."""
    expected = con.sql(sql)
    left = bag(frame.columns, [tuple(r) for r in frame.collect()])
    right = bag(expected.columns, expected.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if only_left or only_right:
        return (
            f"rows {sum(left[1].values())} vs {sum(right[1].values())}; "
            f"only Spark {list(only_left)[:3]}; only SQL {list(only_right)[:3]}"
        )
    return None
