"""Words of a row counted or looked up among each other, a batch of rows at once.

Columns of maps are searched from the beginning for every word, which for long texts grows with the square of their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each entry's row, and the entries."""
    size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
    return np.repeat(np.arange(len(size)), size), lists.flatten()


def _whole(a: pa.Array | pa.ChunkedArray) -> pa.Array:
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def _codes(words: pa.Array) -> tuple[np.ndarray, int]:
    """Words as numbers, and how many there are; null is a word of its own."""
    codes = words.dictionary_encode()
    n = len(codes.dictionary)
    return np.asarray(codes.indices.fill_null(n)).astype(np.int64), n + 1


def _offsets(row: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))


def tallied(words: Column) -> Column:
    """Distinct words of an array with how often each occurs: ``array<struct<word, n>>``, in the order of first occurrence."""

    @F.arrow_udf("array<struct<word: string, n: bigint>>")
    def tally(lists: pa.Array) -> pa.Array:
        lists = _whole(lists)
        row, flat = _flat(lists)
        code, width = _codes(flat)
        _, first, n = np.unique(row * width + code, return_index=True, return_counts=True)
        order = np.argsort(first)
        first, n = first[order], n[order]
        pairs = pa.StructArray.from_arrays([flat.take(pa.array(first)), pa.array(n, pa.int64())], ["word", "n"])
        return pa.ListArray.from_arrays(_offsets(row[first], len(lists)), pairs)

    return tally(words)


def looked_up(words: Column, tokens: Column, values: Column, kind: str) -> Column:
    """For each of a row's words, the value (of the type ``kind``) that goes with it in the row's distinct ``tokens``, or null."""

    @F.arrow_udf(f"array<{kind}>")
    def look(asked: pa.Array, known: pa.Array, given: pa.Array) -> pa.Array:
        asked, known, given = _whole(asked), _whole(known), _whole(given)
        row, flat = _flat(asked)
        at, names = _flat(known)
        code, width = _codes(pa.concat_arrays([flat, names]))
        want, have = row * width + code[:len(flat)], at * width + code[len(flat):]
        order = np.argsort(have)
        have = have[order]
        if (have[1:] == have[:-1]).any():
            raise ValueError("a row's tokens come twice: is its key unique?")
        place = np.minimum(np.searchsorted(have, want), max(0, len(have) - 1))
        hit = have[place] == want if len(have) else np.zeros(len(want), bool)
        index = order[place] if len(have) else place
        return pa.ListArray.from_arrays(_offsets(row, len(asked)), given.flatten().take(pa.array(index, mask=~hit)))

    return look(words, tokens, values)
