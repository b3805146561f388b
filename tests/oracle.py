"""Comparison of a query's rows with its SQL run on the same parquet files."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def order_key(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", "") for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(
        (tuple(plain(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()),
        key=order_key,
    )


def sql_rows(con, sql):
    result = con.execute(sql)
    found = [c[0] for c in result.description]
    names = sorted(found)
    places = [found.index(n) for n in names]
    return names, sorted(
        (tuple(plain(r[i]) for i in places) for r in result.fetchall()), key=order_key
    )


def difference(df, con, sql) -> str | None:
    """None when both give the same rows, else the first difference."""
    names, left = spark_rows(df)
    other, right = sql_rows(con, sql)
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}; first {left[:2]} / {right[:2]}"
    for a, b in zip(left, right):
        if a != b:
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return None
