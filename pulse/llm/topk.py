"""Exact search for the k best inner products: tiles of queries and shards, merged as a tree.

Vectors become whole numbers (:mod:`.vectors`) and are written once, packed in blocks. Queries are dealt
into groups and the table into shards; a task holds the queries of a group and lets the blocks of a shard
stream past. A tile is one matrix product, in the smallest type in which every sum is exact. Of a tile only
what beats the k-th best so far is looked at, a heap of ties included. Each cell of the grid gives k entries
a query; these lists are merged :data:`FAN` at a time. No task holds more than a group of queries and a
tile, and no list more than ``FAN * k`` entries, whatever values repeat.

Defined results: a vector that is null, or holds a null or a component that is not finite, takes no part; of
vectors of different lengths only those of equal length are compared, and empty ones score 0. A row is never its own candidate, a repeated
row is; a query without candidates has no result. Equal scores go by the smaller id, no id coming last.
Scores beyond 64 bits count as the largest. The dimension is not split: a vector has to fit in memory many
times. Further columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settle import settle
from . import vectors
from .arrow import prepare

#: Rows of a block, components of all queries of a group, rows of a shard, least rows of a shard.
BLOCK, GROUP_CELLS, SHARD, LEAST_SHARD = 1024, 1 << 22, 1 << 18, 2048
#: Rows and columns of a tile.
TILE = (256, 8192)
#: Lists that are merged at once.
FAN = 16

_LONGEST = (1 << 63) - 1
_BLOCKS = "length int, kind int, n int, top long, wide int, ids array<long>, rows binary, codes binary"
_FOUND = "row long, query_id long, shard int, best array<struct<minus:long,none:boolean,vec_id:long>>"


def _blocks(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Rows (id, vector, asked) in blocks of one length: all rows as kind 1, those asked for also as kind 0."""
    kept, held = defaultdict(list), 0
    row = TaskContext.get().partitionId() << 40

    def drain(key) -> pa.RecordBatch:
        length, kind = key
        parts = kept.pop(key)
        ids = pa.concat_arrays([p[0] for p in parts])
        rows, matrix = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        wide = vectors.width(matrix)
        return pa.RecordBatch.from_pydict({
            "length": pa.array([length], pa.int32()), "kind": pa.array([kind], pa.int32()), "n": pa.array([len(rows)], pa.int32()),
            "top": pa.array([int(np.abs(matrix).max(initial=0))], pa.int64()), "wide": pa.array([wide], pa.int32()),
            "ids": pa.array([ids], pa.list_(pa.int64())), "rows": pa.array([rows.tobytes()], pa.binary()),
            "codes": pa.array([matrix.astype(f"<i{wide}").tobytes()], pa.binary()),
        })

    for batch in batches:
        ids, asked = batch.column(0).cast(pa.int64()), np.asarray(batch.column(2).fill_null(False))
        for places, matrix in vectors.codes(batch.column(1), scale):
            numbers = row + np.arange(len(places))
            row += len(places)
            for kind, at in ((1, np.arange(len(places))), (0, np.flatnonzero(asked[places]))):
                key = (matrix.shape[1], kind)
                for a in range(0, len(at), BLOCK):
                    part = at[a:a + BLOCK]
                    kept[key].append((ids.take(pa.array(places[part])), numbers[part], matrix[part]))
                    held += len(part)
                    if sum(len(p[1]) for p in kept[key]) >= BLOCK:
                        held -= sum(len(p[1]) for p in kept[key])
                        yield drain(key)
            if held > 16 * BLOCK:  # of many lengths, a few rows each
                yield from [drain(k) for k in list(kept)]
                held = 0
    yield from [drain(k) for k in list(kept)]


class _Lists:
    """The k best entries so far of every query of a group."""

    def __init__(self, k: int, ids: np.ndarray, none: np.ndarray, rows: np.ndarray, codes: np.ndarray, top: int):
        self.k, self.ids, self.none, self.rows, self.codes, self.top = k, ids, none, rows, codes, top
        n = len(ids)
        self.score = np.full((n, k), -_LONGEST - 1)  # below every score: nothing there yet
        self.their, self.lacks = np.full((n, k), _LONGEST), np.ones((n, k), bool)

    def meet(self, ids: np.ndarray, none: np.ndarray, rows: np.ndarray, codes: np.ndarray, top: int) -> None:
        """Take in a tile's width of candidates, given in the order of their ids."""
        bound = self.codes.shape[1] * self.top * top
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound <= _LONGEST else object
        right = codes.astype(kind).T
        for a in range(0, len(self.ids), TILE[0]):
            product = self.codes[a:a + TILE[0]].astype(kind) @ right
            if kind is object:
                product = np.clip(product, -_LONGEST, _LONGEST).astype(np.int64)
            self._select(a, product, ids, none, rows)

    def _select(self, a: int, product: np.ndarray, ids: np.ndarray, none: np.ndarray, rows: np.ndarray) -> None:
        part = slice(a, a + len(product))
        last = self.score[part, -1]
        least = last.astype(product.dtype)  # exact, or far below every product
        hit = product >= least[:, None]
        if product.shape[1] > self.k + 1 and hit.sum() > 4 * self.k * len(product):
            # one more than k: the query's own row may be among them
            at = product.shape[1] - self.k - 1
            hit &= product >= np.partition(product, at, axis=1)[:, at][:, None]
        q, c = np.nonzero(hit)
        s = product[q, c].astype(np.int64)
        end_id, end_none = self.their[part, -1][q], self.lacks[part, -1][q]
        later = (none[c] > end_none) | ((none[c] == end_none) & (ids[c] >= end_id))
        good = ~((s == last[q]) & later) & (rows[c] != self.rows[part][q])
        q, c, s = q[good], c[good], s[good]
        if not len(q):
            return
        # candidates come in the order of their ids, so the first k of equal scores in a row are enough
        order = np.lexsort((c, -s, q))
        q, c, s = q[order], c[order], s[order]
        q, c, s = (x[_place(q) < self.k] for x in (q, c, s))
        who = np.unique(q)
        owner = np.concatenate([np.repeat(who, self.k), q])
        score = np.concatenate([self.score[part][who].ravel(), s])
        their = np.concatenate([self.their[part][who].ravel(), ids[c]])
        lacks = np.concatenate([self.lacks[part][who].ravel(), none[c]])
        # the lowest number has no opposite: ~x falls as x grows
        order = np.lexsort((their, lacks, ~score, owner))
        order = order[_place(owner[order]) < self.k]
        self.score[a + who], self.their[a + who], self.lacks[a + who] = (
            x[order].reshape(-1, self.k) for x in (score, their, lacks))

    def found(self, shard: int) -> pa.RecordBatch:
        full = self.score > -_LONGEST - 1
        size = full.sum(axis=1)
        some = size > 0
        vec_id = pa.array(self.their[full], pa.int64(), mask=self.lacks[full])
        best = pa.StructArray.from_arrays([pa.array(-self.score[full]), pa.array(self.lacks[full]), vec_id], ["minus", "none", "vec_id"])
        ends = np.concatenate([[0], np.cumsum(size[some])]).astype(np.int32)
        return pa.RecordBatch.from_pydict({
            "row": pa.array(self.rows[some]), "query_id": pa.array(self.ids[some], pa.int64(), mask=self.none[some]),
            "shard": pa.array(np.full(some.sum(), shard, np.int32)), "best": pa.ListArray.from_arrays(pa.array(ends), best),
        })


def _place(sorted_keys: np.ndarray) -> np.ndarray:
    """How many equal keys come before each of a sorted array."""
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    first = np.flatnonzero(new)
    return np.arange(len(sorted_keys)) - first[np.cumsum(new) - 1]


def _gathered(parts: list) -> tuple:
    """Ids, which of them are null, row numbers, codes and the largest code of some blocks."""
    ids = pa.concat_arrays([p[0] for p in parts])
    none = np.asarray(ids.is_null())
    return (np.asarray(ids.fill_null(_LONGEST)), none, np.concatenate([p[1] for p in parts]),
            np.concatenate([p[2] for p in parts]), max(p[3] for p in parts))


def _cells(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Lists of every cell from its blocks, those of the queries first."""
    cell, asked, shard, lists = None, [], [], None

    def meet() -> None:
        nonlocal asked, shard, lists
        if lists is None:
            lists, asked = _Lists(k, *_gathered(asked)), []
        ids, none, rows, codes, top = _gathered(shard)
        order = np.lexsort((ids, none))
        for a in range(0, len(order), TILE[1]):
            part = order[a:a + TILE[1]]
            lists.meet(ids[part], none[part], rows[part], codes[part], top)
        shard = []

    def done() -> Iterator[pa.RecordBatch]:
        if asked and shard or lists and shard:
            meet()
        if lists:
            yield lists.found(cell[2])

    for batch in batches:
        for i in range(batch.num_rows):
            b = {name: batch.column(name)[i] for name in batch.schema.names}
            key = tuple(b[name].as_py() for name in ("length", "grp", "shard"))
            if key != cell:
                yield from done()
                cell, asked, shard, lists = key, [], [], None
            codes = vectors.unpacked(b["codes"].as_buffer(), b["wide"].as_py(), key[0])
            n = b["n"].as_py()
            entry = (b["ids"].values, np.frombuffer(b["rows"].as_buffer(), np.int64), codes if key[0] else np.zeros((n, 0), np.int8), b["top"].as_py())
            if b["kind"].as_py() == 0:
                asked.append(entry)
            elif asked or lists:  # a cell without queries has nothing to find
                shard.append(entry)
                if sum(len(p[1]) for p in shard) >= TILE[1]:
                    meet()
    yield from done()


def search(df: DataFrame, id_col: str, vector_col: str, asked: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """For every row that is ``asked``, the ``k`` other rows with the highest inner product of codes.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. See the module for ties, nulls and repeats.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long"), vector_col, asked)
    blocks = settle(rows.mapInArrow(lambda it: _blocks(it, scale), _BLOCKS), "blocks")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = blocks.groupBy("length").agg(F.sum(F.col("n") * F.col("kind")).alias("n"), F.sum(F.col("n") * (1 - F.col("kind"))).alias("asked")).collect()
    grid = [
        (s.length, max(1, -(-s.asked * max(1, s.length) // GROUP_CELLS)), max(1, -(-s.n // SHARD), min(tasks, -(-s.n // LEAST_SHARD))))
        for s in sizes if s.asked
    ]
    plan = spark.createDataFrame(grid, "length int, groups int, shards int")
    placed = blocks.join(plan, "length")
    number = F.xxhash64("rows")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["length", "kind", "n", "top", "wide", "ids", "rows", "codes"]
    queries = placed.where("kind = 0").select(*columns, F.pmod(number, "groups").cast("int").alias("grp"), every("shards").alias("shard"))
    shards = placed.where("kind = 1").select(*columns, every("groups").alias("grp"), F.pmod(number, "shards").cast("int").alias("shard"))
    cells = queries.unionByName(shards).repartition(tasks, "length", "grp", "shard").sortWithinPartitions("length", "grp", "shard", "kind")
    lists = cells.mapInArrow(lambda it: _cells(it, k), _FOUND)
    left = max((g[2] for g in grid), default=1)
    while left > 1:
        left = -(-left // FAN)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("row", "query_id", F.floor(F.col("shard") / FAN).cast("int").alias("shard")).agg(merged.alias("best"))
    return lists.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
