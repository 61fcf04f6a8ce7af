"""Repeated passages: words covered by a window that starts earlier in the corpus are removed.

A window is ``length`` consecutive words of one document. Counting all windows exactly would move
more than the texts themselves, so a count-min sketch of two rows goes first. Every task sketches
its own windows; what it sends is the list of cells it hit, a byte or so each. Segments of the sketch
are merged in parallel and only the bit "twice or more" of a cell is written. The estimate never falls short,
so the second pass loses nothing: it groups the windows estimated repeated by two independent 64-bit hashes
and removes those that occur in a document with a smaller id, or earlier in the same one (told by one hash among its own windows).

Documents with the text of one with a smaller id are removed whole (if they have a window) and do not
take part in the second pass; a large group of copies so costs a row per copy.

The sketch has at most 2 * 2^MOST_BITS cells, of which a worker holds a bit each. In a larger corpus
more windows are estimated repeated; the second pass then moves more rows, with the same result.

Edge cases: null and empty texts, and those with fewer words than a window, keep all words. Rows
with the same id are one document: none of them is earlier than another. Rows without an id lose
only what they repeat themselves, and nothing is removed because of them. Equal windows that overlap
are removed like others. Columns besides id and text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settle import settle
from . import arrow, words

#: Words of a window.
LENGTH = 20
#: Cells of a row of the sketch: 2^bits, about four per window within these bounds. Cells of a segment: 2^SEGMENT.
LEAST_BITS, MOST_BITS, SEGMENT = 18, 29, 22
#: Windows that a task sketches at a time.
FLUSH = 2 << 20

_loaded: dict[tuple, list[np.ndarray]] = {}


def _windows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a batch's windows, the word each starts at, and the first word of every row."""
    body, rows = words.texts(column)
    starts, ends, first = words.bounds(body, rows)
    h = words.windows(words.hashes(body, starts, ends), length)
    n = np.diff(first)
    whole = np.ones(len(h), bool)
    for k in range(1, length):  # the last words of a row start no window
        at = first[1:][n >= k] - k
        whole[at[at < len(h)]] = False
    return h[whole], np.flatnonzero(whole), first


def _second(column: pa.Array, length: int, at: np.ndarray) -> np.ndarray:
    """Another hash of the windows that start at the words ``at``, independent of the first."""
    body, rows = words.texts(column)
    starts, ends, _ = words.bounds(body, rows)
    codes = words.mix(words.hashes(body, starts, ends) ^ np.uint64(0xA0761D6478BD642F))
    return words.windows(codes, length)[at] if len(at) else np.zeros(0, np.uint64)


def _cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (words.mix(h ^ np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.int64)


def _pack(sorted_cells: np.ndarray) -> bytes:
    """Rising numbers as steps in bytes; 255 means that many more and on to the next byte."""
    step = np.diff(sorted_cells, prepend=0)
    at = np.cumsum(step // 255 + 1) - 1
    made = np.full(int(at[-1]) + 1 if len(at) else 0, 255, np.uint8)
    made[at] = step % 255
    return made.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    step = np.frombuffer(packed, np.uint8)
    return np.cumsum(step, dtype=np.int64)[step < 255]


def _sketch(docs: DataFrame, length: int, bits: int) -> DataFrame:
    """``row``, ``segment``, ``bits``: for each segment of the sketch, which of its cells count two or more."""
    low = min(SEGMENT, bits)

    def flush(found: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(found)
        out = []
        for row in (0, 1):
            cells = np.sort(_cells(h, row, bits))
            new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            cells, many = cells[new], np.diff(np.r_[new, len(cells)]) > 1
            cut = np.searchsorted(cells, np.arange((1 << (bits - low)) + 1) << low)
            for segment in np.flatnonzero(np.diff(cut)):
                own, twice = cells[cut[segment]:cut[segment + 1]] - (int(segment) << low), many[cut[segment]:cut[segment + 1]]
                out.append((row, int(segment), _pack(own), _pack(own[twice])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["row", "segment", "once", "twice"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for b in batches:
            h, _, _ = _windows(b["text"], length)
            found.append(h)
            n += len(h)
            if n >= FLUSH:
                yield flush(found)
                found, n = [], 0
        if n:
            yield flush(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, at = np.zeros(1 << low, np.uint8), None
        names = ["row", "segment", "bits"]

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([np.packbits(counts > 1, bitorder="little").tobytes()], pa.binary())], names)

        for b in batches:
            for row, segment, once, twice in zip(b["row"].to_pylist(), b["segment"].to_pylist(), b["once"], b["twice"]):
                if (row, segment) != at:
                    if at:
                        yield done()
                    counts[:] = 0
                    at = row, segment
                for packed in (once, twice):
                    cells = _unpack(packed.as_py())
                    counts[cells] = np.minimum(counts[cells] + 1, 2)
        if at:
            yield done()

    parts = docs.select(F.col("text")).mapInArrow(count, "row int, segment int, once binary, twice binary")
    return parts.repartition("row", "segment").sortWithinPartitions("row", "segment").mapInArrow(merge, "row int, segment int, bits binary")


def _repeated(files: tuple[str, ...], bits: int) -> list[np.ndarray]:
    """The merged sketch, a bit per cell, read once per worker from the shared folder."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    if (files, bits) not in _loaded:
        _loaded.clear()
        low = min(SEGMENT, bits)
        rows = [np.zeros(max(1, (1 << bits) // 8), np.uint8) for _ in (0, 1)]
        for name in files:
            store, path = fs.FileSystem.from_uri(name)
            with store.open_input_file(path) as f:
                for b in pq.ParquetFile(f).iter_batches(8):
                    for row, segment, packed in zip(b["row"].to_pylist(), b["segment"].to_pylist(), b["bits"]):
                        own = np.frombuffer(packed.as_py(), np.uint8)
                        at = (segment << low) // 8
                        rows[row][at:at + len(own)] = own
        _loaded[files, bits] = rows
    return _loaded[files, bits]


def _candidates(docs: DataFrame, files: tuple[str, ...], bits: int, length: int) -> DataFrame:
    """``h``, ``g``, ``id``: two hashes of the distinct windows of every document that the sketch counts twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _repeated(files, bits)
        for b in batches:
            h, at, first = _windows(b["text"], length)
            for row in (0, 1):
                cells = _cells(h, row, bits)
                maybe = (rows[row][cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
                h, at = h[maybe], at[maybe]
            of = np.searchsorted(first, at, "right") - 1
            order = np.lexsort((h, of))
            h, of, g = h[order], of[order], _second(b["text"], length, at)[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])] if len(h) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(g[new].view(np.int64)), b["id"].take(pa.array(of[new]))], ["h", "g", "id"])

    return docs.mapInArrow(run, "h long, g long, id long")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (the words left, one space between them)."""
    arrow.prepare(docs.sparkSession)
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(4 * size / 6 + 1))))
    files = tuple(settle(_sketch(own, length, bits), "sketch").inputFiles())

    named = own.where("id IS NOT NULL AND text IS NOT NULL").select("id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(17), "text").alias("b"))
    heads = named.groupBy("a", "b").agg(F.min("id").alias("head"), F.max("id").alias("tail")).where("head < tail").drop("tail")
    copies = named.join(heads, ["a", "b"]).where("id > head").groupBy("id").agg(F.collect_set("a").alias("texts"))
    copies = settle(copies, "text-copies")

    # one plan, so that texts are dealt out by id once for both uses
    copy = F.coalesce(F.array_contains("texts", F.xxhash64("text")), F.lit(False))
    marked = own.join(copies, "id", "left").select("id", "text", copy.alias("copy"))
    found = _candidates(marked.where("NOT copy AND id IS NOT NULL").select("id", "text"), files, bits, length)
    heads = found.groupBy("h", "g").agg(F.min("id").alias("head"))
    later = found.join(heads, ["h", "g"]).where("id > head").groupBy("id").agg(F.collect_list("h").alias("later"))
    rows = marked.join(later, "id", "left")
    return rows.mapInArrow(_remove(length), "doc_id long, n_words long, n_removed long, kept_text string")


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, rows = words.texts(b["text"])
            starts, ends, first = words.bounds(body, rows)
            h, at, _ = _windows(b["text"], length)
            cut = np.searchsorted(at, first)
            copy = b["copy"].to_pylist()
            keep = np.ones(len(starts), bool)
            for i in range(b.num_rows):
                own, place = h[cut[i]:cut[i + 1]], at[cut[i]:cut[i + 1]]
                if not len(own):
                    continue
                if copy[i]:
                    keep[first[i]:first[i + 1]] = False
                    continue
                gone = np.ones(len(own), bool)
                gone[np.unique(own, return_index=True)[1]] = False
                if b["later"][i].is_valid:
                    gone |= np.isin(own, b["later"][i].values.to_numpy().view(np.uint64))
                if gone.any():
                    change = np.zeros(int(first[i + 1] - first[i]) + 1, np.int64)
                    np.add.at(change, place[gone] - first[i], 1)
                    np.add.at(change, place[gone] - first[i] + length, -1)
                    keep[first[i]:first[i + 1]] = np.cumsum(change[:-1]) == 0
            yield pa.RecordBatch.from_arrays([
                b["id"], pa.array(np.diff(first), pa.int64()), pa.array(np.diff(first) - np.diff(np.r_[0, np.cumsum(keep)][first]), pa.int64()),
                _rebuilt(body, starts, ends, first, keep)], ["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def _rebuilt(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of every row with one space between them."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[keep]
    starts, size = starts[keep], (ends - starts)[keep]
    each = np.bincount(row, size + 1, len(first) - 1).astype(np.int64)
    place = np.cumsum(np.r_[0, size + 1])[:-1] - row_breaks(row, each)
    offsets = np.r_[0, np.cumsum(np.maximum(each - 1, 0))]
    made = np.full(int(offsets[-1]), 32, np.uint8)
    total = int(size.sum())
    within = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    made[np.repeat(place, size) + within] = body[np.repeat(starts, size) + within]
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(made)).cast(pa.string())


def row_breaks(row: np.ndarray, each: np.ndarray) -> np.ndarray:
    """How many rows with words lie before each word's: so many spaces fewer are written before it."""
    return (np.cumsum(each > 0) - (each > 0))[row] if len(row) else np.zeros(0, np.int64)
