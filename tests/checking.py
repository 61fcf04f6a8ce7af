"""Compare a Spark query with its SQL over the same tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v) + 0.0:.6f}"
    if isinstance(v, datetime.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_KINDS = {"long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(list(types), result.fetchall())
    if set(types) != set(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(types)}"
    for f in df.schema.fields:
        if _KINDS.get(f.dataType.typeName(), "?") != types[f.name]:
            return f"type of {f.name}: {f.dataType.typeName()} != {types[f.name]}"
    actual = _rows(df.columns, df.collect())
    if not actual and not expected:
        return "both are empty"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"{sum(x != y for x, y in zip(actual, expected))} rows differ, first {str(a)[:600]} != {str(b)[:600]}"
    return None
