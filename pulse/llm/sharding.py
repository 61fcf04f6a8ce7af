"""Shards of nearly equal bytes by sampled splitters.

Records are ordered by the hash of their text, then by id, so copies lie together. A size-weighted
sample of keys gives quantile boundaries of many ranges, each small enough for a task. One pass
counts the bytes and rows of every range exactly; overfull ranges are sampled again, more densely,
and subdivided. A text heavier than a range is cut between ids. With exact sums per range, each
record's place in the whole order follows from running sums within its range, and shard s takes
the places whose bytes lie in the s-th of equal shares. Only slim rows (id, size, hashes) are moved.

A group of equal texts stays in one shard if it has at most ``GROUP_SHARE`` of a shard's bytes: no range begins within it,
however thin ranges are. Larger ones are cut like other records. Shards so differ by a record, or that share, at most.

Edge cases: a null or empty text has 16 bytes. Repeated rows are separate records. Rows without an
id come before others of the same text. With fewer records than shards some shards are empty; no
records give no rows. Columns besides id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..settle import settle
from . import arrow

#: Bytes that a record has besides its text.
OVERHEAD = 16
#: Records of a range, about; ranges at least per shard and at most in all; sampled keys per range.
RANGE_ROWS, RANGES_PER_SHARD, MOST_RANGES, SAMPLES = 200_000, 4, 1 << 15, 32
#: A range is overfull beyond so many times the mean; rounds of subdividing at most.
OVERFULL, ROUNDS = 2.0, 4
#: Share of a shard up to which equal texts are kept together.
GROUP_SHARE = 0.01

_LOWEST = -(1 << 63)


def _sample(rows: DataFrame, rate: float, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys drawn with a chance of size times ``rate`` (1 at most), in order, and the bytes each stands for."""
    u = F.pmod(F.xxhash64("h", "id", "size", F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    got = rows.where(u < chance).select("h", F.coalesce("id", F.lit(_LOWEST)).alias("id"), (F.col("size") / chance).alias("w")).collect()
    h, i, w = (np.array([r[k] for r in got], t) for k, t in enumerate((np.int64, np.int64, float)))
    order = np.lexsort((i, h))
    return h[order], i[order], w[order]


def _splitters(h: np.ndarray, i: np.ndarray, w: np.ndarray, ranges: int) -> list[tuple[int, int]]:
    """Keys at which new ranges begin: quantiles of the weights. A text is only cut if two quantiles fall into it."""
    if not len(h) or ranges < 2:
        return []
    total = np.cumsum(w)
    at = np.minimum(np.searchsorted(total, total[-1] * np.arange(1, ranges) / ranges), len(h) - 1)
    own = h[at]
    many = np.r_[False, own[1:] == own[:-1]]
    return sorted({(int(a), int(b) if m else _LOWEST) for a, b, m in zip(own, i[at], many)})


def _ranges(h: np.ndarray, i: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """For every key, how many splitters it has reached."""
    first, second = splitters[:, 0], splitters[:, 1]
    low, high = np.searchsorted(first, h, "left"), np.searchsorted(first, h, "right")
    found, tied = low.copy(), np.flatnonzero(low < high)
    for k in np.unique(low[tied]):
        own = tied[low[tied] == k]
        found[own] = k + np.searchsorted(second[k:high[own[0]]], i[own], "right")
    return found


def _dealt(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with their ``range``. The splitters travel with the task (MOST_RANGES of them, and what subdividing adds)."""
    table = np.array(splitters, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _ranges(b["h"].to_numpy(), b["id"].fill_null(_LOWEST).to_numpy(), table)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.int64())], [*b.schema.names, "range"])

    return rows.mapInArrow(run, "id long, size long, crc long, h long, range long")


def _uncut(splitters: list[tuple[int, int]], slim: DataFrame, least: int) -> list[tuple[int, int]]:
    """The splitters, those within a text lighter than ``least`` moved to its beginning, by exact weights of the texts they cut."""
    cut = sorted({h for h, i in splitters if i != _LOWEST})
    if not cut:
        return splitters
    asked = F.broadcast(slim.sparkSession.createDataFrame([(h,) for h in cut], "h long"))  # a row per splitter at most
    light = {r.h for r in slim.join(asked, "h").groupBy("h").agg(F.sum("size").alias("weight")).collect() if r.weight <= least}
    return sorted({(h, _LOWEST if h in light else i) for h, i in splitters})


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot``, ``grown_shard`` (null)."""
    spark = docs.sparkSession
    arrow.prepare(spark)
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(F.col(key).cast("long").alias("id"), (F.octet_length(value) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(F.encode(value, "utf-8")).alias("crc"), F.xxhash64(value).alias("h"))
    slim = settle(slim, "shard-records")
    n, total = slim.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MOST_RANGES, max(RANGES_PER_SHARD * shards, -(-n // RANGE_ROWS)))

    whole_text = int(GROUP_SHARE * total / shards)
    splitters = _uncut(_splitters(*_sample(slim, ranges * SAMPLES / max(1, total), 1), ranges), slim, whole_text)
    for step in range(ROUNDS):
        dealt = _dealt(slim, splitters)
        counted = dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("most")).collect()  # a row per range
        full = {r.range: r.bytes for r in counted if r.n > 1 and r.bytes > OVERFULL * total / ranges and r.bytes > 2 * r.most}
        if not full or step == ROUNDS - 1:
            break
        inside = dealt.where(F.col("range").isin(list(full))).drop("range")
        # denser in every round, within what the driver takes
        dense = min(4 ** (step + 1) * ranges * SAMPLES / max(1, total), 4 * MOST_RANGES * SAMPLES / sum(full.values()))
        h, i, w = _sample(inside, dense, 2 + step)
        of = _ranges(h, i, np.array(splitters, np.int64).reshape(-1, 2))
        more = [x for k, b in full.items() for x in _splitters(h[of == k], i[of == k], w[of == k], int(-(-b * ranges // total)))]
        grown = sorted({*splitters, *_uncut(more, slim, whole_text)})
        if len(grown) == len(splitters):
            break
        splitters = grown

    before = np.zeros((len(splitters) + 2, 2), np.int64)
    for r in counted:
        before[r.range + 1] = r.bytes, r.n
    before = np.cumsum(before, axis=0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = before[b["range"].to_numpy()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at[:, 0]), pa.array(at[:, 1])], [*b.schema.names, "bytes_before", "rows_before"])

    known = dealt.mapInArrow(place, "id long, size long, crc long, h long, range long, bytes_before long, rows_before long")
    along = W.partitionBy("range").orderBy("h", "id")
    group = W.partitionBy("range", "h")
    run = known.withColumns({
        "start": F.col("bytes_before") + F.coalesce(F.sum("size").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")),
        "row": F.col("rows_before") + F.row_number().over(along) - 1})
    run = run.withColumns({"from": F.min("start").over(group), "weight": F.sum("size").over(group)})
    whole = F.col("weight") <= F.lit(whole_text)
    middle = F.when(whole, F.col("from") * 2 + F.col("weight")).otherwise(F.col("start") * 2 + F.col("size"))
    share = F.least(F.lit(shards - 1), F.expr("middle * {0} div {1}".format(shards, max(1, 2 * total)))).cast("int")
    run = settle(run.withColumn("middle", middle).withColumn("shard", share).select("id", "size", "crc", "row", "shard"), "shards")
    first = F.broadcast(run.groupBy("shard").agg(F.min("row").alias("first")))  # a row per shard
    return run.join(first, "shard").select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` (one row per id) as Parquet in a subfolder per shard, in order of slots; returns the assignment.

    Rows are dealt by ranges of (shard, slot), so a shard is written by many tasks in order. Folders are named ``shard=``, with
    an underscore more for each column of ``docs`` that has the name already; all its own columns are written.
    """
    put = settle(shard(docs, shards, key, text), "shards")
    ident, number, place = (arrow.fresh(c, docs.columns) for c in ("_id", "shard", "slot"))
    at = put.select(F.col("doc_id").alias(ident), F.col("shard").alias(number), F.col("slot").alias(place))
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = docs.join(at, F.col(key).eqNullSafe(F.col(ident))).drop(ident)
    rows.repartitionByRange(int(parts), number, place).sortWithinPartitions(number, place).write.partitionBy(number).parquet(folder)
    return put
