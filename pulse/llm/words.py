"""Words of whole Arrow batches, hashed without a Python object per word.

Words are the runs between ASCII white space. A batch's texts lie in one buffer; word bounds come
from a table look-up per byte, and hashes from eight bytes of every word at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
#: Words beyond this many bytes are hashed one by one.
_LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row begins in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def bounds(body: np.ndarray, rows: np.ndarray, outside: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each row's first word (one more at the end)."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
    inside = ~outside[body]
    before = np.empty(len(body), bool)
    before[0] = False
    before[1:] = inside[:-1]
    edge = rows[1:-1]
    edge = edge[(edge > 0) & (edge < len(body))]
    first = inside & ~before
    first[edge] = inside[edge]
    last = np.empty(len(body), bool)
    last[-1] = inside[-1]
    last[:-1] = inside[:-1] & ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, rows)


def hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word; equal words have equal hashes wherever they lie."""
    size = ends - starts
    h = size.astype(np.uint64) * _A
    if not len(starts):
        return h
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(body) + 1,), "<u8", padded, strides=(1,))
    which = None
    for at in range(0, min(int(size.max()), _LONG), 8):
        if at:
            which = np.flatnonzero(size > at) if which is None else which[size[which] > at]
            h[which] = mix((h[which] + _A) ^ (eight[starts[which] + at] & _MASKS[np.minimum(size[which] - at, 8)]))
        else:
            h = mix((h + _A) ^ (eight[starts] & _MASKS[np.minimum(size, 8)]))
    for i in np.flatnonzero(size > _LONG):
        h[i] = xxhash.xxh3_64_intdigest(body[starts[i]:ends[i]].tobytes())
    return h


def windows(codes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` codes; entry i covers codes i to i + length - 1.

    Runs over the whole array, also across rows; callers leave out those that cross.
    """
    if len(codes) < length:
        return np.zeros(0, np.uint64)
    done, size = None, 0
    power, span = codes, 1
    todo = length
    while True:
        if todo & 1:
            n = len(codes) - size - span + 1
            done = power[:n] if done is None else mix(done[:n] * _A + power[size:size + n])
            size += span
        todo >>= 1
        if not todo:
            return mix(done + np.uint64(length))
        n = len(power) - span
        power = mix(power[:n] * _C + power[span:span + n])
        span *= 2
