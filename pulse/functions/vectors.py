"""Class-score vectors: arrays of doubles with one cell per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(z: Column, n: int) -> Column:
    """Probabilities of ``n`` logits, shifted by the largest so that nothing overflows.

    Unrolled over the classes, which keeps it in generated code.
    """
    top = F.array_max(z)
    parts = [F.exp(z[i] - top) for i in range(n)]
    total = sum(parts[1:], parts[0])
    return F.array(*[p / total for p in parts])


def log_sum_exp(z: Column, n: int) -> Column:
    top = F.array_max(z)
    parts = [F.exp(z[i] - top) for i in range(n)]
    return top + F.log(sum(parts[1:], parts[0]))


def argmax(z: Column) -> Column:
    """Index of the largest cell, from 0; the first one on ties."""
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def confidence(p: Column) -> Column:
    """Largest cell."""
    return F.array_max(p)


def one_hot(y: Column, n: int) -> Column:
    """``n`` zeros with a one at ``y``; null for a null label."""
    cells = F.array(*[F.when(y == i, 1.0).otherwise(0.0) for i in range(n)])
    return F.when(y.isNotNull(), cells)


def linear(x: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """Logits ``W x + b`` of a feature array, for fixed weights."""

    def logit(w: Sequence[float], b: float) -> Column:
        ws = F.array(*[F.lit(float(v)) for v in w])
        products = F.zip_with(x, ws, lambda a, c: a * c)
        return F.aggregate(products, F.lit(float(b)), lambda acc, v: acc + v)

    return F.array(*[logit(w, b) for w, b in zip(weights, bias, strict=True)])
