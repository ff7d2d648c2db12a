"""Comparison of a Spark result with DuckDB's answer to the counterpart SQL."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if value is None:
        return "<null>"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, Decimal):
        return f"d:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return "<nan>" if math.isnan(value) else f"f:{value:.9g}"
    if isinstance(value, datetime):
        return f"t:{value.isoformat(sep=' ')}"
    if isinstance(value, date):
        return f"day:{value.isoformat()}"
    return f"s:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def differences(con, df, sql, show=3):
    """Empty text when both agree."""
    spark_columns, ours = spark_rows(df)
    duck_columns, theirs = duck_rows(con, sql)
    if spark_columns != duck_columns:
        return f"columns differ: {set(spark_columns) ^ set(duck_columns)}"
    if ours == theirs:
        return ""
    only_ours = sorted(set(ours) - set(theirs))[:show]
    only_theirs = sorted(set(theirs) - set(ours))[:show]
    detail = ""
    if only_ours and only_theirs and len(only_ours[0]) > 8:
        detail = str([(c, a, b) for c, a, b in zip(spark_columns, only_ours[0], only_theirs[0]) if a != b])
    return f"{len(ours)} vs {len(theirs)} rows {detail or (only_ours, only_theirs)}"
