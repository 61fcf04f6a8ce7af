"""Computing a costly expression once.

The optimizer copies an expression into every place that refers to it when it merges
projections or pushes filters down, and shared parts inside higher-order functions are not
recognised again. For text work those copies would dominate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as a generator of one row each, which later filters are not pushed through."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(made)))


def once_where(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Add the column ``name`` and keep the rows whose value passes ``keep``, in one step."""
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.filter(F.array(value), keep)).alias(name))
