"""Runs a registered query and its comparison SQL and reports how they differ."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

#: SQL types as the comparison engine names them -> Spark's names
SAME_TYPE = {
    "BIGINT": "bigint", "HUGEINT": "decimal(38,0)", "INTEGER": "int", "VARCHAR": "string",
    "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both sides agree, otherwise a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected = con.execute(sql).fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    spark_types = dict(df.dtypes)
    for name, kind, *_ in described:
        wanted = SAME_TYPE.get(kind, kind)
        if spark_types[name] != wanted:
            return f"type of {name}: {spark_types[name]} != {kind}"
    actual = df.collect()
    left, right = rows_of(df.columns, actual), rows_of(names, expected)
    if left != right:
        extra, missing = list((left - right).items()), list((right - left).items())
        return (
            f"{len(actual)} rows against {len(expected)};"
            f" {len(extra)} only here {str(extra[:2])[:600]};"
            f" {len(missing)} only there {str(missing[:2])[:600]}"
        )
    if not expected:
        return "both sides are empty"
    return None
