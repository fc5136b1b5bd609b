"""Runs a registered query and its SQL on the same files and compares all rows."""

from __future__ import annotations

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
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    return None if value is None else str(value)


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, [tuple(r) for r in cursor.fetchall()]


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when both give the same columns and rows."""
    df = query(spark, sf_dir)
    left_names, left = as_bag(df.columns, [tuple(r) for r in df.collect()])
    right_names, right = as_bag(*sql_rows(con, sql))
    if left_names != right_names:
        return f"columns {left_names} against {right_names}"
    if left != right:
        return (
            f"{sum(left.values())} rows against {sum(right.values())}; "
            f"only Spark {list((left - right).items())[:3]}; only SQL {list((right - left).items())[:3]}"
        )
    return ""
