"""Timestamps and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period letters; weeks begin on Monday.
UNITS = {"D": "day", "W": "week", "M": "month"}


def epoch_to_string(seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` wall clock of ``zone``, whatever the session zone."""
    whole = F.floor(seconds)
    zero = F.lit(0)
    step = F.make_dt_interval(zero, zero, zero, whole.cast("decimal(18,6)"))
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + step
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("string")


def parse_timestamp(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp without zone; null if it does not parse."""
    return col.try_cast("timestamp_ntz")


def period_start(ts: Column, period: str) -> Column:
    """First day of the day, week or month that holds ``ts``."""
    if period not in UNITS:
        raise ValueError(f"period must be one of {', '.join(UNITS)}, not {period!r}")
    day = ts.cast("date")
    return day if period == "D" else F.trunc(day, UNITS[period])
