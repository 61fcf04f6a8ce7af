"""Quoted CSV read by byte ranges, though its texts hold line breaks.

Whether a line break ends a record depends on all quotes before it. So the quotes of every range are counted first, modulo two;
their running sum over a file's ranges, one slim row each, says which ranges begin inside a text. Then every range
cuts itself into records, and only what lies across a border is moved: the open end of a range and the
beginnings of those after it, up to the end of that record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..settle import settle
from .files import CSV_OPTIONS, LABELLED_TEXT

_PIECES = "file string, start long, head boolean, open boolean, first boolean, text string"
_TYPES = [("file", pa.string()), ("start", pa.int64()), ("head", pa.bool_()), ("open", pa.bool_()), ("first", pa.bool_()), ("text", pa.string())]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, where their range starts, and their order in it."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )


def _beginnings(lines: DataFrame) -> DataFrame:
    """One row per range that lines start in: is its first line ``inside`` a quoted text?"""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1
    return settle(odd.select("file", "start", inside.alias("inside")), "csv-ranges")


class _Range:
    """The pieces of one range, from runs of its lines."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start = file, start
        self.odd, self.head = int(inside), inside
        self.first = start == 0
        self.pending: list[pa.Array] = []

    def _piece(self, texts: pa.Array, head: bool, open_: bool, first: bool) -> pa.RecordBatch:
        n = len(texts)
        cells = ([self.file] * n, [self.start] * n, [head] * n, [open_] * n, [first] * n)
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, (_, t) in zip(cells, _TYPES)), texts], names=[c for c, _ in _TYPES])

    def _joined(self) -> pa.Array:
        text = "\n".join(pa.concat_arrays(self.pending).to_pylist())
        self.pending = []
        return pa.array([text], pa.string())

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """Pieces that end in these lines."""
        after = (self.odd + np.cumsum(np.asarray(pc.count_substring(lines, '"')))) & 1
        ends = np.flatnonzero(after == 0)
        self.odd = int(after[-1])
        begin = 0
        if len(ends) and (self.pending or self.head):
            begin = int(ends[0]) + 1
            self.pending.append(lines[:begin])
            yield self._piece(self._joined(), self.head, False, self.first and not self.head)
            self.first, self.head, ends = self.first and self.head, False, ends[1:]
        if len(ends) and self.first:
            yield self._piece(pc.binary_join(self._lists(lines, begin, ends[:1]), "\n"), False, False, True)
            self.first, begin, ends = False, int(ends[0]) + 1, ends[1:]
        if len(ends):
            yield self._piece(pc.binary_join(self._lists(lines, begin, ends), "\n"), False, False, False)
            begin = int(ends[-1]) + 1
        if begin < len(lines):
            self.pending.append(lines[begin:])

    @staticmethod
    def _lists(lines: pa.Array, begin: int, ends: np.ndarray) -> pa.Array:
        bounds = np.concatenate([[0], ends + 1 - begin]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), lines[begin:int(ends[-1]) + 1])

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.pending:
            yield self._piece(self._joined(), self.head, True, self.first and not self.head)


def _pieces(batches: Iterator[pa.RecordBatch], borders: bool) -> Iterator[pa.RecordBatch]:
    """Records that lie in one range, or else (``borders``) the parts of those that do not."""
    at: _Range | None = None

    def wanted(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces:
            if borders == (p.column("head")[0].as_py() or p.column("open")[0].as_py()):
                yield p

    for batch in batches:
        value, file, start = (batch.column(i) for i in range(3))
        inside = batch.column(3)
        place = np.asarray(start)
        name = np.asarray(file.dictionary_encode().indices)
        cuts = np.flatnonzero((place[1:] != place[:-1]) | (name[1:] != name[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)]):
            if a == b:
                continue
            if at is None or (at.file, at.start) != (file[a].as_py(), int(place[a])):
                if at:
                    yield from wanted(at.close())
                at = _Range(file[a].as_py(), int(place[a]), inside[a].as_py())
            yield from wanted(at.add(value[a:b]))
    if at:
        yield from wanted(at.close())


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as they are written, one per row in ``text``, with the ``file`` and whether it is the file's ``first``.

    Empty lines are no records.
    """
    ship_package(spark)
    lines = _lines(spark, path)
    # a broadcast leaves lines where they are; if there are too many ranges for one, lines move and are put in order
    placed = lines.join(_beginnings(lines), ["file", "start"]).select("value", "file", "start", "inside", "line")
    ordered = placed.sortWithinPartitions("file", "start", "line").drop("line")
    whole = ordered.mapInArrow(lambda it: _pieces(it, False), _PIECES).select("file", "first", "text")
    parts = settle(ordered.mapInArrow(lambda it: _pieces(it, True), _PIECES), "csv-borders")
    # at most an end and a beginning per range; an end that was not inside a record begins one
    in_file = W.partitionBy("file").orderBy("start", F.desc("head"))
    number = F.sum((~F.col("head")).cast("long")).over(in_file)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", ~F.col("head"), "text"))), lambda p: p["text"]), "\n")
    # only places are numbered file by file; the texts stay spread
    numbered = parts.select("file", "start", "head", number.alias("record"))
    across = parts.join(numbered, ["file", "start", "head"]).groupBy("file", "record").agg(F.max("first").alias("first"), joined.alias("text"))
    records = whole.unionByName(across.select("file", "first", "text"))
    ending = F.col("text").endswith("\r")
    text = F.when(ending, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return records.withColumn("text", text).where("text <> ''")


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType = LABELLED_TEXT) -> DataFrame:
    """The rows of :func:`.files.read_labelled_csv`, from as many tasks as the files have ranges, however large one file is.

    Files have a header, UTF-8 texts and records ended by a line feed, with or without a carriage return. A quote may only stand around a
    value or doubled within one: that is what CSV writers produce, and what the running count relies on. Lines are
    read three times: to count quotes, to find the parts at borders, and for the records. No order of rows is kept. A
    record with too few values has nulls for the rest. Line ends inside texts stay as they are, where the other reader
    turns those of a file whose records end the same way into line feeds.
    """
    records = split_records(spark, path).where(~F.col("first"))
    parsed = F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), CSV_OPTIONS)
    return records.select(parsed.alias("row")).select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields])
