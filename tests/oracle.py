"""Run a registered query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value.is_integer() else float(f"{value:.12g}"))
    if isinstance(value, Decimal):
        return plain(float(value))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql):
    """Problems found, none when the results agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if got != expected:
        problems.append(f"{sum(got.values())} rows against {sum(expected.values())}")
        problems += [f"only spark {r}" for r in list((got - expected))[:3]]
        problems += [f"only sql   {r}" for r in list((expected - got))[:3]]
    return problems
