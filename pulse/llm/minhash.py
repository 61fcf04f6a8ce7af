"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Two random permutations of a universe of 2^20 cells make all coordinates: the first scatters a
document's shingles, the second gives their ranks, and coordinate k is the least rank after the
scattered cells are shifted by k around the circle. Bands of coordinates are the buckets.

Documents with equal shingle sets form a class and only its smallest id goes on. In every bucket
all members are compared with its smallest member on full sets, and links are joined to
components. Buckets that still hold several components are then worked through pair by pair, in
blocks: the members outside a bucket's largest component meet all, pairs in one component are skipped, pairs whose signatures differ by six standard errors
more than a link may are skipped, pairs that share an earlier band are left to that bucket, and all
others are verified on full sets. So every pair of texts that shares a bucket is linked or proven
not to be, or lies in one component already, but no bucket emits its pairs.

Edge cases: a null or empty text, or one without words, has no shingles and is a component of its
own. Fewer words than a shingle has are one shingle. Rows with the same id are one document. A row
without an id takes the component of its text, if another document has that; else null. Tables
without rows give no rows. Further columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settle import settle
from . import arrow, words
from .components import components

#: Words of a shingle and least similarity in percent, unless a caller says otherwise.
SHINGLE, PERCENT = 5, 80
#: Cells of the circle (a power of two) and seed of the permutations.
CELLS, SEED = 1 << 20, 20
#: Largest chance that a pair at the threshold shares no band.
MISS = 1e-6
#: Members of a bucket, and shingles of all of them, that are compared in one piece; larger buckets are split in such blocks.
BLOCK, BLOCK_SHINGLES = 3000, 4 << 20

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def bands_for(percent: int, miss: float = MISS) -> tuple[int, int]:
    """Rows per band and bands: the longest band of up to 5 rows that needs at most 40 bands."""
    j = percent / 100
    for rows in (5, 4, 3, 2):
        bands = math.ceil(math.log(miss) / math.log1p(-j ** rows)) if j < 1 else 1
        if bands <= 40:
            return rows, bands
    return 1, math.ceil(math.log(miss) / math.log1p(-j))


def _circle(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and all runs of ``size`` ranks that end in a cell of the second."""
    if size not in _tables:
        rng = np.random.default_rng(SEED)
        scatter = rng.permutation(CELLS)
        rank = rng.permutation(CELLS).astype(np.uint32)
        _tables[size] = scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([rank[CELLS - size + 1:], rank]), size)
    return _tables[size]


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a set of shingle hashes that is not empty."""
    scatter, runs = _circle(size)
    cells = scatter[(shingles >> np.uint64(44)).astype(np.int64)]
    least = runs[cells[:8192]].min(axis=0)
    for at in range(8192, len(cells), 8192):
        least = np.minimum(least, runs[cells[at:at + 8192]].min(axis=0))
    return least


def shingle_sets(column: pa.Array, length: int) -> Iterator[np.ndarray]:
    """For every text its distinct shingles as sorted hashes, of words with A-Z in lower case."""
    body, rows = words.texts(column)
    body = words.LOWER[body]
    starts, ends, first = words.bounds(body, rows)
    codes = words.hashes(body, starts, ends)
    runs = words.windows(codes, length)
    for a, b in zip(first[:-1], first[1:]):
        yield np.unique(runs[a:b - length + 1]) if b - a >= length else words.windows(codes[a:b], int(b - a)) if b > a else codes[:0]


def signed(docs: DataFrame, key: str, text: str, length: int, percent: int) -> DataFrame:
    """``id``, ``n``, the hash of the set (``hi``, ``lo``), ``bands`` and ``sketch`` (a byte per coordinate)."""
    per, count = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, names, rows = [], [], []
            for s in shingle_sets(b["text"], length):
                n.append(len(s))
                names.append(xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None)
                rows.append(signature(s, per * count) if len(s) else np.zeros(per * count, np.uint32))
            full = np.array(n) > 0
            sig = np.array(rows, np.uint32).reshape(len(n), count, per).astype(np.uint64)
            h = np.tile(np.arange(1, count + 1).astype(np.uint64), (len(n), 1))
            for k in range(per):
                h = words.mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
            cut = (np.concatenate([[0], np.cumsum(full)]) * count).astype(np.int32)
            half = lambda shift: pa.array([None if x is None else ((x >> shift) & (2**64 - 1)) - 2**63 for x in names], pa.int64())
            yield pa.RecordBatch.from_arrays([
                b["id"], pa.array(n, pa.int64()), half(64), half(0), pa.ListArray.from_arrays(cut, pa.array(h[full].reshape(-1).view(np.int64))),
                pa.array([bytes(x) for x in sig.reshape(len(n), -1).astype(np.uint8)], pa.binary())], ["id", "n", "hi", "lo", "bands", "sketch"])

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(run, "id long, n long, hi long, lo long, bands array<long>, sketch binary")


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``id``, ``set`` for the wanted documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b["text"], length))
            cut = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b["id"], pa.ListArray.from_arrays(cut, pa.array(flat.view(np.int64)))], ["id", "set"])

    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return own.join(ids, "id", "left_semi").mapInArrow(run, "id long, set array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    right = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(left, "b").join(right, "a")
    n, m = F.size("set_a"), F.size("set_b")
    near = (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.size(F.array_intersect("set_a", "set_b")) * (100 + percent) >= (n + m) * percent)
    return both.where(near).select("a", "b")


class _Forest:
    """Which of a few members are joined."""

    def __init__(self, labels) -> None:
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def link_members(key: int, ids, comps, side, sets, bands, sketches, percent: int, head: int | None = None) -> list[tuple[int, int]]:
    """Links that join the components of one bucket's members, or of two blocks of them.

    ``side`` tells the blocks apart; all zero: compare everyone with everyone. ``head`` is the smallest
    member of the whole bucket, which need not be among these; it has been compared with all.
    """
    size = np.array([len(s) for s in sets])
    sketch = np.array(sketches)
    column = int(np.flatnonzero(bands[0] == key)[0]) if (bands[0] == key).any() else 0
    j = percent / 100
    need = (j - 6 * math.sqrt(j * (1 - j) / sketch.shape[1])) * sketch.shape[1]
    two = len(set(side)) > 1
    found = []  # compact: a bucket of similar texts has millions of pairs to look at
    for u in range(len(ids) - 1):
        if ids[u] == head:
            continue
        v = np.arange(u + 1, len(ids))
        ok = (comps[v] != comps[u]) & (np.minimum(size[v], size[u]) * 100 >= np.maximum(size[v], size[u]) * percent)
        if two:
            ok &= side[v] != side[u]
        v = v[ok]
        if not len(v):
            continue
        agree = (sketch[v] == sketch[u]).sum(axis=1)
        ok = agree >= need
        if column:
            ok &= ~(bands[v, :column] == bands[u, :column]).any(axis=1)
        found.append((agree[ok].astype(np.int16), np.full(int(ok.sum()), u, np.int32), v[ok].astype(np.int32)))
    if not found:
        return []
    agree, left, right = (np.concatenate(x) for x in zip(*found))
    forest, links = _Forest(comps.tolist()), []
    for at in np.argsort(-agree, kind="stable"):  # the likeliest links first: they spare most of the others
        u, v = int(left[at]), int(right[at])
        a, b = forest.root(u), forest.root(v)
        if a != b:
            both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
            if both * (100 + percent) >= (size[u] + size[v]) * percent:
                forest.up[a] = b
                links.append((min(ids[u], ids[v]), max(ids[u], ids[v])))
    return links


def dealt(wide: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, each once per cell of blocks in which it is compared.

    Members of a bucket's largest component need not be compared with each other. So only the others are
    compared with all: a bucket of m members of which r lie outside its largest component gives
    about m * r / BLOCK + m rows. A bucket that fits in one block is one cell.
    """
    parts = wide.groupBy("key", "comp").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    bulk = parts.groupBy("key").agg(
        F.max(F.struct("rows", "shingles", "comp")).alias("most"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.count("*").alias("comps"))
    blocks = lambda rows, shingles: F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
    fits = blocks(F.col("rows"), F.col("shingles")) <= 1
    rest = F.when(fits, 1).otherwise(blocks(F.col("rows") - F.col("most.rows"), F.col("shingles") - F.col("most.shingles")))
    most = F.when(fits, 0).otherwise(blocks(F.col("most.rows"), F.col("most.shingles")))
    bulk = bulk.where("comps > 1").select("key", "most.comp", rest.alias("rest"), most.alias("most"))
    rows = wide.join(bulk.withColumnRenamed("comp", "bulk"), "key")
    apart = (F.col("most") > 0) & (F.col("comp") == F.col("bulk"))
    some = F.xxhash64("id", "key")
    mine = F.when(apart, F.col("rest") + F.pmod(some, "most")).otherwise(F.pmod(some, "rest")).cast("int")
    others = F.sequence(F.lit(0), F.col("rest") - 1 + F.when(apart, 0).otherwise(F.col("most")))
    rows = rows.select("key", "id", "comp", "head", mine.alias("side"), F.explode(others).alias("other"))
    return rows.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "comp", "head")


def _links_between(shared: DataFrame, reps: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame | None:
    """Further links in buckets of three or more that hold several components."""
    labels = comps.select(F.col("node").alias("id"), "component")
    wide = shared.where("m > 2").join(labels, "id", "left").select("key", "id", "n", "head", F.coalesce("component", "id").alias("comp"))
    rows = settle(dealt(settle(wide, "near-wide")), "near-mixed")
    if rows.isEmpty():
        return None
    full = rows.join(reps.select("id", "bands", "sketch"), "id").join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = [], None

        def done() -> list[tuple[int, int]]:
            if len(group) < 2:
                return []
            ids, comps, side, heads, members, bands, sketches = zip(*group)
            side = np.array(side) if at[1] != at[2] else np.zeros(len(ids))
            return link_members(at[0], ids, np.array(comps), side, members, np.array(bands), sketches, percent, heads[0])

        def out(links) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            keys = list(zip(b["key"].to_pylist(), b["i"].to_pylist(), b["j"].to_pylist()))
            cells = zip(keys, b["id"].to_pylist(), b["comp"].to_pylist(), b["side"].to_pylist(), b["head"].to_pylist(), b["set"], b["bands"], b["sketch"])
            links = []
            for k, *cell, members, bands, sketch in cells:
                if k != at:
                    links += done()
                    group, at = [], k
                group.append((*cell, members.values.to_numpy(), bands.values.to_numpy(), np.frombuffer(sketch.as_py(), np.uint8)))
            yield out(links)
        yield out(done())

    cells = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return settle(cells.select("key", "i", "j", "id", "comp", "side", "head", "set", "bands", "sketch").mapInArrow(run, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept``."""
    arrow.prepare(docs.sparkSession)
    marked = settle(signed(docs, key, text, length, percent), "near-signed")
    named = marked.where("n > 0 AND id IS NOT NULL")
    one = named.groupBy("hi", "lo").agg(F.min("id").alias("id"))
    reps = settle(named.join(one, ["hi", "lo", "id"]).dropDuplicates(["hi", "lo", "id"]), "near-classes")

    cells = reps.select("id", "n", F.explode("bands").alias("key"))
    heads = cells.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("m")).where("m > 1")
    shared = settle(cells.join(heads, "key"), "near-buckets")
    ids = settle(shared.select("id").distinct(), "near-ids")
    sets = settle(_sets(docs, ids, key, text, length), "near-sets")
    pairs = shared.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    links = settle(_verified(pairs, sets, percent), "near-links")
    comps = settle(components(links), "near-components")
    more = _links_between(shared, reps, sets, comps, percent)
    if more is not None:
        comps = components(links.union(more))

    of = reps.select("hi", "lo", F.col("id").alias("rep")).join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    of = of.select("hi", "lo", F.coalesce("component", "rep").alias("found"))
    rows = marked.select("id", "n", "hi", "lo").join(of, ["hi", "lo"], "left")
    component = F.coalesce("found", "id")
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id; rows without an id stay."""
    other = arrow.fresh("_gone", docs.columns)
    gone = near_duplicates(docs, key, text, length, percent).where(~F.col("kept")).select(F.col("doc_id").alias(other))
    return docs.join(gone.distinct(), F.col(key) == F.col(other), "left_anti")
