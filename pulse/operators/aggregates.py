"""Counts per period and label, word frequencies, length statistics."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import UNITS, period_start
from ..functions.text import split_words, token_count
from .periods import period_number

# Column order of the period table.
TABLE_LABELS = ("negative", "neutral", "positive")


def label_pivot(
    df: DataFrame,
    ts_col: str = "comment_created",
    label_col: str = "sentiment_labels",
    period: str = "W",
    labels: Sequence[str] = TABLE_LABELS,
    other: str | None = None,
) -> DataFrame:
    """One row per period: its number and start, one count per label, and the number of labelled rows.

    Labels that are not listed are in the ``total``, and in a column of their own if ``other``
    names one. Conditional counts need one shuffle of already combined rows, and the label list fixes
    the schema. The period number is taken on one row per period, over all dated rows, as
    :func:`with_period` does; periods without a labelled row are then left out.
    """
    dated = df.where(F.col(ts_col).isNotNull()).select(
        period_start(F.col(ts_col), period).alias("period_date"), F.col(label_col).alias("label")
    )
    counts = dated.groupBy("period_date").agg(
        *[F.count_if(F.col("label") == name).alias(name) for name in labels], F.count("label").alias("total")
    )
    rest = sum((F.col(name) for name in labels), F.lit(0).cast("long"))
    extra = [(F.col("total") - rest).alias(other)] if other else []
    numbered = counts.select(period_number().alias("period_int"), "period_date", *labels, *extra, "total")
    return numbered.where(F.col("total") > 0)


def label_counts(
    df: DataFrame,
    ts_col: str = "comment_created",
    label_col: str = "sentiment_labels",
    period: str = "W",
    labels: Sequence[str] = TABLE_LABELS,
    zero_fill: bool = False,
) -> DataFrame:
    """Line-plot data: ``period_int, period_date, label, n`` for every label that occurs.

    A label absent from a period has no row, unless ``zero_fill`` asks for one with 0 for each of
    ``labels``.
    """
    dated = df.where(F.col(ts_col).isNotNull()).select(
        period_start(F.col(ts_col), period).alias("period_date"), F.col(label_col).alias("label")
    )
    counts = dated.groupBy("period_date", "label").agg(F.count(F.lit(1)).alias("n"))
    long = counts.select(period_number().alias("period_int"), "period_date", "label", "n").where(F.col("label").isNotNull())
    if not zero_fill:
        return long
    # one more row of 0 per listed label and counted row; all of them are already few per period
    names = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    zeros = long.select("period_int", "period_date", names, F.lit(0).cast("long").alias("n"))
    return long.unionByName(zeros).groupBy("period_int", "period_date", "label").agg(F.sum("n").alias("n"))


def label_calendar(
    df: DataFrame, ts_col: str = "comment_created", label_col: str = "sentiment_labels", period: str = "W",
    labels: Sequence[str] = TABLE_LABELS,
) -> DataFrame:
    """``period_int, period_date, label, n`` for every period from the first to the last dated row, absent ones included.

    Each of ``labels`` has a row in each period, 0 where it does not occur; other labels have rows where they
    occur. ``period_int`` counts the calendar's periods, so gaps count too. The calendar comes from the bounds, two scalars of
    the counts; no rows are joined with it. An empty table has no calendar.
    """
    dated = df.where(F.col(ts_col).isNotNull()).select(
        period_start(F.col(ts_col), period).alias("period_date"), F.col(label_col).alias("label"))
    counts = dated.groupBy("period_date", "label").agg(F.count(F.lit(1)).alias("n"))
    bounds = counts.agg(F.min("period_date").alias("lo"), F.max("period_date").alias("hi")).where(F.col("lo").isNotNull())
    every = F.sequence("lo", "hi", F.expr(f"INTERVAL 1 {UNITS[period]}"))
    names = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    zeros = bounds.select(F.explode(every).alias("period_date")).select("period_date", names, F.lit(0).cast("long").alias("n"))
    filled = counts.where(F.col("label").isNotNull()).unionByName(zeros).groupBy("period_date", "label").agg(F.sum("n").alias("n"))
    return filled.select(period_number().alias("period_int"), "period_date", "label", "n")


def word_counts(df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """``word, n`` over the white-space words of a column."""
    words = df.select(F.explode(split_words(F.col(text_col))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(
    df: DataFrame,
    text_col: str = "clean_text",
    n: int = 20,
    stopwords: Iterable[str] = (),
    ties: str = "word",
    order_col: str | None = None,
) -> DataFrame:
    """The ``n`` most frequent words that are not stop words.

    Equal counts are ordered by the word, or, with ``ties='first_seen'``, by the first
    occurrence in the order of ``order_col``.
    """
    listed = list(stopwords)
    if ties == "word":
        counts = word_counts(df, text_col)
        order = [F.desc("n"), F.asc("word")]
    elif ties == "first_seen" and order_col:
        words = df.select(order_col, F.posexplode(split_words(F.col(text_col))).alias("pos", "word"))
        counts = words.groupBy("word").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(order_col, "pos")).alias("seen")
        )
        order = [F.desc("n"), F.asc("seen")]
    else:
        raise ValueError("ties must be 'word', or 'first_seen' together with order_col")
    if listed:
        counts = counts.where(~F.col("word").isin(listed))
    return counts.orderBy(*order).limit(n).select("word", "n")


def _length_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Texts per token count: all that the length statistics need of the table.

    Doubles from here on, so that no decimal arithmetic creeps in.
    """
    texts = df.where(F.col(text_col).isNotNull())
    lengths = texts.select(token_count(F.col(text_col)).cast("double").alias("len"))
    return lengths.groupBy("len").agg(F.count(F.lit(1)).alias("n"))


def length_hist(df: DataFrame, text_col: str = "clean_text", bins: int = 30) -> DataFrame:
    """Histogram of the token counts: ``bin, bin_lo, bin_hi, n`` for every one of ``bins`` bins.

    Equal widths from the smallest to the largest length; the last bin is closed. If all texts
    are equally long the range is widened by a half on both sides.
    """
    lengths = _length_counts(df, text_col)
    # the bounds read the same exchange as the counts, so the texts are scanned once
    lo, hi = F.min("len"), F.max("len")
    pad = F.when(lo == hi, 0.5).otherwise(0.0)
    bounds = lengths.agg(
        F.struct((lo - pad).alias("lo"), (hi + pad).alias("hi"), F.sum("n").alias("n")).alias("b")
    ).scalar()
    width = (bounds["hi"] - bounds["lo"]) / F.lit(float(bins))
    filled = lengths.select(
        F.least(F.floor((F.col("len") - bounds["lo"]) / width), F.lit(bins - 1)).alias("bin"), "n"
    )
    empty = df.sparkSession.range(bins).select(F.col("id").alias("bin"), F.lit(0).cast("long").alias("n"))
    out = filled.unionByName(empty).groupBy("bin").agg(F.sum("n").alias("n"))
    at = F.col("bin").cast("double")
    return out.select(
        F.col("bin").cast("int").alias("bin"),
        (bounds["lo"] + at * width).alias("bin_lo"),
        (bounds["lo"] + (at + 1.0) * width).alias("bin_hi"),
        "n",
    ).where(bounds["n"].isNotNull())


def length_density(
    df: DataFrame, text_col: str = "clean_text", points: int = 200, bins: int = 30
) -> DataFrame:
    """Gaussian density of the token counts on an even grid, scaled to the histogram's counts.

    Bandwidth by Scott's rule. The work grows with the number of different lengths, not with
    the number of texts. Empty if the lengths do not vary.
    """
    lengths = _length_counts(df, text_col)
    total = F.sum("n")
    mean = F.sum(F.col("len") * F.col("n")) / total
    stats = lengths.agg(
        F.struct(
            F.min("len").alias("lo"),
            F.max("len").alias("hi"),
            total.cast("double").alias("n"),
            mean.alias("mean"),
        ).alias("s")
    ).scalar()
    spread = lengths.agg(
        F.sqrt(F.sum(F.col("n") * F.pow(F.col("len") - stats["mean"], F.lit(2.0)))
               / (F.sum("n") - 1)).alias("sd")
    ).scalar()
    step = (stats["hi"] - stats["lo"]) / F.lit(float(points - 1))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    cells = lengths.where(stats["hi"] > stats["lo"]).select("len", "n", grid)
    x = stats["lo"] + F.col("point").cast("double") * step
    h = spread * F.pow(stats["n"], F.lit(-0.2))
    z = (x - F.col("len")) / h
    mass = F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z))
    bin_width = (stats["hi"] - stats["lo"]) / F.lit(float(bins))
    return cells.groupBy("point").agg(mass.alias("mass")).select(
        "point",
        x.alias("x"),
        (F.col("mass") / (h * F.lit(math.sqrt(2 * math.pi))) * bin_width).alias("density"),
    )


def label_stats(df: DataFrame, label_col: str) -> DataFrame:
    """One row: number of rows, of columns and of distinct labels."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.count_distinct(label_col).alias("n_labels"),
    )
