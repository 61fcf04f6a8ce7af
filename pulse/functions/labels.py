"""The three label codings, kept apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored sentiment -> class number.
STORED_TO_CLASS = {-1: 2, 0: 0, 1: 1}
# Class number -> name.
SENTIMENTS = ("neutral", "positive", "negative")
# Emotion number -> name.
EMOTIONS = ("Sadness", "Joy", "Love", "Anger", "Fear", "Surprise")


def encode_labels(col: Column, mapping: Mapping[int, int] = STORED_TO_CLASS) -> Column:
    """Stored label -> class number; null where the label is not in the mapping."""
    pairs = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return pairs[col.cast("int")]


def decode(col: Column, names: Sequence[str] = SENTIMENTS) -> Column:
    """Class number -> name; null where there is no such class."""
    pairs = F.create_map(*[v for i, n in enumerate(names) for v in (F.lit(i), F.lit(n))])
    return pairs[col.cast("int")]
