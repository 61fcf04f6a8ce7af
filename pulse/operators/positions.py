"""Row positions of files: rows numbered in file order without moving them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settle import settle


def with_position(rows: DataFrame, name: str = "position") -> DataFrame:
    """Add a row's number from 0, by file name, then place in the file.

    ``rows`` must come straight from a file reader, without filters. Every range of a file that a task reads counts
    its rows; the running sum over ranges, one slim row each, gives where a range begins. Rows stay where they are and
    are not sorted. The files are scanned twice, the first time for no column.
    """
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()}
    placed = rows.select(*rows.columns, *[c.alias(n) for n, c in place.items()])
    counts = placed.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_first"))
    before = W.orderBy("_file", "_start").rowsBetween(W.unboundedPreceding, -1)
    # lines of a range are numbered without a gap, so the range's first number and offset place them all
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    ranges = settle(counts.select("_file", "_start", offset.alias("_offset")), "ranges")
    joined = placed.join(ranges, ["_file", "_start"])
    return joined.select(*rows.columns, (F.col("_offset") + F.col("_line")).alias(name))


def glue_by_position(left: DataFrame, right: DataFrame, name: str = "position") -> DataFrame:
    """The rows of two file tables side by side: first with first, second with second. Keeps ``name``.

    Both must come straight from a reader. They must be equally long: a missing partner raises an error when the result is computed.
    """
    a, b = with_position(left, name), with_position(right, name)
    pairs = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), name, "full")
    fine = F.assert_true(F.col("_a").isNotNull() & F.col("_b").isNotNull(), "tables differ in length")
    checked = pairs.withColumn("_fine", fine).where(F.col("_fine").isNull())
    return checked.drop("_a", "_b", "_fine")
