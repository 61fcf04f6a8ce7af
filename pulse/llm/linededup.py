"""Boilerplate lines: those that a large share of a site's pages contain.

For every host and line, the pages that contain the line are divided by the pages of the host;
lines above the ratio go from all pages of that host. DataFrame functions only.

A line is compared without spaces around it, by two 64-bit hashes. Blank lines are never counted
and always stay. A page whose every line would go is a repeated page rather than boilerplate and
stays as it is.

Edge cases: a null text stays null and an empty one empty; both count as pages of their host.
Pages with a null host form one host. Repeated rows are pages of their own. A line repeated in a
page counts once there. Columns besides text and host are untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let, once
from ..settle import settle

#: A line goes if more than this share of its host's pages contain it, and at least so many pages do.
RATIO, LEAST_PAGES = 0.1, 5


def _mark(line: Column) -> Column:
    key = F.trim(line)
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(17), key).alias("b"))


def _filled(lines: Column) -> Column:
    return F.filter(lines, lambda x: F.trim(x) != "")


def boilerplate(pages: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``host``, ``marks``: a row per host that has boilerplate, with the hashes of those lines.

    A page adds its distinct lines only, counted before the shuffle where a task sees them again. As
    no page has more lines than it has, a host keeps at most (mean lines of a page / ratio) marks.
    """
    own = pages.select(host.alias("host"), F.col(text).alias("text"))
    total = own.groupBy("host").agg(F.count("*").alias("pages"))
    line = F.explode(F.array_distinct(F.transform(_filled(F.split("text", "\n", -1)), _mark))).alias("m")
    seen = own.select("host", line).groupBy("host", F.col("m.a").alias("a"), F.col("m.b").alias("b")).agg(F.count("*").alias("n"))
    often = seen.where(F.col("n") >= least).join(total.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
    often = often.where(F.col("n") > F.col("pages") * ratio)
    return often.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("marks"))


def drop_lines(pages: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """Per page: its row as struct ``page``, the cleaned ``text``, and ``n_lines`` and ``n_dropped``.

    The marks are written first: the planner then sees their size, broadcasts them while they are
    small and otherwise joins by host, where adaptive execution splits a hot host.
    """
    marks = settle(boilerplate(pages, host, text, ratio, least), "boilerplate")
    inner = pages.select(F.struct("*").alias("page"), host.alias("host"), F.col(text).alias("text"))
    both = inner.join(marks.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")), "left").select("page", "text", "marks")

    def cut(lines: Column) -> Column:
        kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("marks"), _mark(x)))
        return let(kept, lambda k: F.when(F.size(_filled(k)) > 0, k).otherwise(lines))

    # where a host has no marks the text is not even split
    split = F.when(F.col("marks").isNotNull() & F.col("text").isNotNull(), let(F.split("text", "\n", -1), lambda x: F.struct(
        F.size(x).cast("long").alias("n"), let(cut(x), lambda k: F.struct(F.array_join(k, "\n").alias("text"), F.size(k).cast("long").alias("left"))).alias("kept"))))
    made = once(both, cut=split)
    whole = F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.col("cut.kept.text"))
    n = F.when(F.col("cut").isNull(), F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.size(F.split("text", "\n", -1)).cast("long"))).otherwise(F.col("cut.n"))
    dropped = F.when(F.col("cut").isNull(), F.lit(0).cast("long")).otherwise(F.col("cut.n") - F.col("cut.kept.left"))
    return made.select("page", whole.alias("text"), n.alias("n_lines"), dropped.alias("n_dropped"))
