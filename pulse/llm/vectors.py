"""Vectors as whole numbers: every component scaled and rounded down, in as few bytes as it needs.

A row takes part if its vector and all components are there and finite. Components beyond 2^53 in
absolute value, after scaling, count as that bound, so that every code is exact as a double.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

FARTHEST = 2.0**53
_WIDTHS = (1, 2, 4, 8)


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def codes(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length of vector: the places of the rows that take part, and their codes as a matrix of int64."""
    column = flat(column)
    if not len(column):
        return
    size = column.value_lengths()
    there = ~np.asarray(size.is_null())
    size = np.asarray(size.fill_null(0)).astype(np.int64)
    values = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    begin = np.cumsum(size) - size
    for length in np.unique(size[there]):
        rows = np.flatnonzero(there & (size == length))
        cells = values[begin[rows][:, None] + np.arange(length)] if length else np.zeros((len(rows), 0))
        whole = np.isfinite(cells).all(axis=1)
        with np.errstate(over="ignore"):
            scaled = np.clip(np.floor(cells[whole] * scale), -FARTHEST, FARTHEST)
        yield rows[whole], scaled.astype(np.int64)


def width(matrix: np.ndarray) -> int:
    """Bytes that the largest code needs."""
    top = int(np.abs(matrix).max(initial=0))
    return next(w for w in _WIDTHS if top < 1 << (8 * w - 1))


def unpacked(data: bytes | memoryview, wide: int, length: int) -> np.ndarray:
    """Rows of codes from their bytes."""
    found = np.frombuffer(data, f"<i{wide}")
    return found.reshape(-1, length) if length else np.zeros((0, 0), np.int8)
