"""Benchmark passages in documents, found by one Aho-Corasick automaton over all windows of the items.

Texts are normalised to words of a-z, 0-9 and non-ASCII bytes (A-Z in lower case) with one space
between them. A window is ``length`` consecutive words of an item, or all of an item that has
fewer. A whole batch of documents is scanned once as one string; hits are mapped back to words and
to character offsets of the original text.

The items are written to the shared folder, in blocks of about ``BLOCK_CHARS`` characters by the hash
of their id; the driver sees only their files' names. A worker holds the automaton of one block at
a time. With one block it is built once per worker; with more, texts are gathered up to
``CHUNK_BYTES`` and scanned by block after block. Documents are not shuffled in either case.

Edge cases: null texts, and texts or items without words, have no hits. Items without an id are
ignored; items with the same id count once. Repeated documents are scanned each. An empty
benchmark finds nothing, empty documents give no rows. Columns besides id and text are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard_at_exit, shared_dir
from . import arrow, words

#: Words of a window.
LENGTH = 10
#: Characters of items that one automaton holds (a few hundred bytes of memory each at most).
BLOCK_CHARS = 1 << 20
#: Bytes of documents that a worker gathers before it goes through several blocks.
CHUNK_BYTES = 64 << 20

_OUTSIDE = np.ones(256, bool)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _OUTSIDE[_lo:_hi] = False

_built: dict[tuple, ahocorasick.Automaton] = {}


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One string for a batch: ``" w1 w2 \\n w1 "``, a line per row.

    Also, per word: its place in that string and its first and last byte in the batch; and the first
    word and first byte of each row.
    """
    body, rows = words.texts(column)
    low = words.LOWER[body]
    starts, ends, first = words.bounds(low, rows, _OUTSIDE)
    size = ends - starts
    row = np.repeat(np.arange(len(rows) - 1), np.diff(first))
    # a space before each word, and a space and a line end after each row
    place = np.cumsum(np.concatenate([[0], size + 1]))[:-1] + 1 + 2 * row
    line = np.full(int(size.sum()) + len(size) + 2 * (len(rows) - 1), 32, np.uint8)
    inside = np.flatnonzero(~_OUTSIDE[low])
    line[inside + np.repeat(place - starts, size)] = low[inside]
    line_ends = np.cumsum(np.bincount(row, size + 1, len(rows) - 1).astype(np.int64) + 2) - 1 if len(rows) > 1 else np.zeros(0, np.int64)
    line[line_ends] = 10
    return line, place, starts, ends, first, rows


def patterns(items: list[tuple[str, str]], length: int) -> dict[str, tuple[int, set[str]]]:
    """Every window as normalised text with a space on both sides: its words, and the ids of its items."""
    found: dict[str, tuple[int, set[str]]] = {}
    line, place, starts, ends, first, _ = normalised(pa.array([x for _, x in items], pa.string()))
    text = line.tobytes().decode("latin-1")
    for (name, _), a, b in zip(items, first[:-1], first[1:]):
        span = min(length, int(b - a))
        for w in range(a, b - span + 1 if b > a else a):
            last = w + span - 1
            found.setdefault(text[place[w] - 1:place[last] + ends[last] - starts[last] + 1], (span, set()))[1].add(name)
    return found


def _items(files: tuple[str, ...]) -> list[tuple[str, str]]:
    """Ids and texts of one block, from the shared folder; a block that no item fell into has no files."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    found = []
    for name in files:
        store, path = fs.FileSystem.from_uri(name)
        with store.open_input_file(path) as f:
            for b in pq.ParquetFile(f).iter_batches(columns=["id", "text"]):
                found += zip(b["id"].to_pylist(), b["text"].to_pylist())
    return found


def _automaton(files: tuple[str, ...], length: int) -> ahocorasick.Automaton:
    key = files, length
    if key not in _built:
        _built.clear()
        machine = ahocorasick.Automaton()
        for text, (span, names) in patterns(_items(files), length).items():
            machine.add_word(text, (span, tuple(sorted(names))))
        machine.make_automaton()
        _built[key] = machine
    return _built[key]


def _chunks(batches: Iterator[pa.RecordBatch], blocks: list) -> Iterator[list[pa.RecordBatch]]:
    """Batches to scan together: one by one for a single block, else up to about CHUNK_BYTES."""
    chunk, size = [], 0
    for b in batches:
        chunk.append(b)
        size += b.nbytes
        if len(blocks) == 1 or size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint ranges (end exclusive) that cover the same."""
    made: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if made and a <= made[-1][1]:
            made[-1] = made[-1][0], max(b, made[-1][1])
        else:
            made.append((a, b))
    return made


def _blocks(items: DataFrame, item: str, item_text: str) -> list[tuple[str, ...]]:
    """The files of every block that the items are written to; at least one block."""
    spark = items.sparkSession
    bench = items.select(F.col(item).cast("string").alias("id"), F.col(item_text).cast("string").alias("text")).dropna()
    blocks = 1 + (bench.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS
    folder = shared_dir(spark, "benchmark")
    dealt = bench.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    dealt.repartition("block").write.partitionBy("block").parquet(folder)
    discard_at_exit(spark, folder)
    made: list[list[str]] = [[] for _ in range(blocks)]
    for name in spark.read.schema("id string, text string, block long").parquet(folder).inputFiles():  # a file per block
        if "/block=" in name:  # no items: a file outside of any block
            made[int(name.rsplit("/block=", 1)[1].split("/")[0])].append(name)
    return [tuple(sorted(x)) for x in made]


def _scan(blocks: list[tuple[str, ...]], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, blocks):
            seen: list[tuple[dict, dict]] = [({}, {}) for _ in chunk]
            for files in blocks:
                machine = _automaton(files, length)
                for b, (spans, names) in zip(chunk, seen if len(machine) else ()):
                    line, place, _, _, first, _ = normalised(b["text"])
                    matches = list(machine.iter(line.tobytes().decode("latin-1")))
                    last = np.searchsorted(place, [at for at, _ in matches], "right") - 1
                    which = np.searchsorted(first, last, "right") - 1
                    for w, i, (_, (span, ids)) in zip(last.tolist(), which.tolist(), matches):
                        w -= int(first[i])
                        spans.setdefault(i, []).append((w - span + 1, w + 1))
                        names.setdefault(i, set()).update(ids)
                    for i, x in spans.items():
                        spans[i] = _joined(x)
            for b, (spans, names) in zip(chunk, seen):
                yield _found(b, spans, names)

    return run


def _found(b: pa.RecordBatch, spans: dict[int, list], names: dict[int, set]) -> pa.RecordBatch:
    body, rows = words.texts(b["text"])
    starts, ends, first = words.bounds(words.LOWER[body], rows, _OUTSIDE)
    hits = [[_hit(body, rows[i], starts, ends, first[i], x) for x in spans.get(i, ())] for i in range(b.num_rows)]
    items = [sorted(names.get(i, ())) for i in range(b.num_rows)]
    return pa.RecordBatch.from_arrays([
        b["id"], b["text"], pa.array(np.diff(first), pa.int64()), pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string()))],
        ["id", "text", "n", "hits", "items"])


_HITS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def _hit(body: np.ndarray, row: int, starts: np.ndarray, ends: np.ndarray, base: int, span: tuple[int, int]) -> dict:
    """Words and code points of one covered range."""
    points = lambda a, b: int(((body[a:b] & 0xC0) != 0x80).sum())
    at, to = starts[base + span[0]], ends[base + span[1] - 1]
    start = points(row, at)
    return {"first": span[0], "last": span[1], "start": start, "end": start + points(at, to)}


def find_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``id``, ``text``, ``n`` (words), ``hits`` (word and character ranges, end exclusive), ``items`` (sorted ids)."""
    arrow.prepare(docs.sparkSession)
    found = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    made = found.withColumns({"n": F.lit(None).cast("long"), "hits": F.lit(None).cast("array<struct<first:long,last:long,start:long,end:long>>"), "items": F.lit(None).cast("array<string>")})
    return found.mapInArrow(_scan(_blocks(items, item, item_text), length), made.schema)


def contamination(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans`` (code points)."""
    found = find_passages(docs, items, **names)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"])
    spans = F.array_join(F.transform("hits", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_words"), hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), spans.alias("spans"))


def keep_unseen(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; no shuffle, columns as they are."""
    arrow.prepare(docs.sparkSession)
    return docs.mapInArrow(_drop(_blocks(items, item, item_text), length, text), docs.schema)


def _drop(blocks: list[tuple[str, ...]], length: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, blocks):
            for files in blocks:
                machine = _automaton(files, length)
                for j, b in enumerate(chunk if len(machine) else ()):
                    line, place, _, _, first, _ = normalised(b[text])
                    at = [x for x, _ in machine.iter(line.tobytes().decode("latin-1"))]
                    hit = np.zeros(b.num_rows, bool)
                    hit[np.searchsorted(first, np.searchsorted(place, at, "right") - 1, "right") - 1] = True
                    chunk[j] = b.filter(pa.array(~hit))
            yield from chunk

    return run
