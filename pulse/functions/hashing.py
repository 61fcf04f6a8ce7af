"""Order by md5 of a row key: random-looking, seeded, and independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX = 8


def key_hash(key: Column, seed: str | int) -> Column:
    """32 hex digits for a row key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def in_fraction(key: Column, fraction: float, seed: str | int) -> Column:
    """True for about ``fraction`` of the keys. A map-side test: no shuffle, no count."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    cut = round(fraction * 16**HEX)
    if cut >= 16**HEX:
        return key_hash(key, seed).isNotNull()
    return F.substring(key_hash(key, seed), 1, HEX) < F.lit(f"{cut:0{HEX}x}")
