"""Filters, samples and splits of labelled texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.binding import once_where
from ..functions.hashing import in_fraction, key_hash
from ..functions.text import token_count
from ..settle import settle

_EDGE_HEX = 5


def length_filter(df: DataFrame, text_col: str = "text", lo: int = 2, hi: int = 1000) -> DataFrame:
    """Keep texts of ``lo`` to ``hi`` white-space tokens; adds ``text_len``."""
    return once_where(df, "text_len", token_count(F.col(text_col)), lambda n: n.between(lo, hi))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: str | int) -> DataFrame:
    """About ``fraction`` of the rows, chosen by the hash of the row key, without a shuffle."""
    return df.where(in_fraction(F.col(key), fraction, seed))


def _hash_cut(
    df: DataFrame, key: str, seed: str | int, want: Callable[[Column], Column],
    strata: Sequence[str],
) -> DataFrame:
    """The largest key hash, as ``_cut``, among the first ``want(size)`` rows of each stratum.

    First by key hash, that is. The table is neither sorted nor gathered: counts per leading
    hash digits locate the digits in which the quota ends, and the few rows with those digits
    are ranked. A stratum of any size puts at most 16^5 counters, and one row in 16^5, into one
    task. ``key`` must be unique.
    """
    strata = list(strata)
    hashed = df.select(*strata, key_hash(F.col(key), seed).alias("_h"))
    lead = F.substring("_h", 1, _EDGE_HEX).alias("_lead")
    counts = hashed.groupBy(*strata, lead).agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(*strata)
    running = counts.select(
        *strata, "_lead", "_n",
        F.sum("_n").over(whole.orderBy("_lead")).alias("_upto"),
        want(F.sum("_n").over(whole)).cast("long").alias("_want"),
    )
    before = F.col("_upto") - F.col("_n")
    edge = settle(
        running.where((F.col("_want") > before) & (F.col("_want") <= F.col("_upto")))
        .select(*strata, "_lead", (F.col("_want") - before).alias("_need")),
        "edge",
    )
    rows, at = hashed.withColumn("_lead", lead).alias("r"), edge.alias("e")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*strata, "_lead"]]
    near = rows.join(at, reduce(Column.__and__, same)).select("r.*", "e._need")
    ranked = near.withColumn("_rn", F.row_number().over(whole.orderBy("_h")))
    return settle(
        ranked.where(F.col("_rn") == F.col("_need")).select(*strata, F.col("_h").alias("_cut")),
        "cut",
    )


def _mark_first(
    df: DataFrame, key: str, seed: str | int, cut: DataFrame, strata: Sequence[str], mark: str
) -> DataFrame:
    """Add the boolean ``mark``: whether the key hash is within the stratum's cut."""
    here = key_hash(F.col(key), seed)
    if not strata:
        last = cut.select("_cut").scalar()
        return df.withColumn(mark, F.coalesce(here <= last, F.lit(False)))
    rows, at = df.alias("r"), cut.alias("c")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in strata]
    joined = rows.join(at, reduce(Column.__and__, same), "left").select("r.*", "c._cut")
    return joined.withColumn(mark, F.coalesce(here <= F.col("_cut"), F.lit(False))).drop("_cut")


def exact_sample(df: DataFrame, key: str, fraction: float, seed: str | int) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows (halves to even), chosen by key hash."""
    cut = _hash_cut(df, key, seed, lambda n: F.bround(n * F.lit(float(fraction))), [])
    return _mark_first(df, key, seed, cut, [], "_in").where("_in").drop("_in")


def split(
    df: DataFrame, key: str, seed: str | int, test: float = 0.1, val: float = 0.2
) -> DataFrame:
    """Add ``split``: test first, then ``val`` of what is left, the rest train.

    A row's place depends on its key alone, so columns kept in different tables stay aligned,
    and new rows never move old ones. Shares are approximate; see :func:`exact_split`.
    """
    is_test = in_fraction(F.col(key), test, f"{seed}/test")
    is_val = in_fraction(F.col(key), val, f"{seed}/val")
    return df.withColumn("split", F.when(is_test, "test").when(is_val, "val").otherwise("train"))


def exact_split(
    df: DataFrame, key: str, seed: str | int, test: float = 0.1, val: float = 0.2,
    stratify: str | None = None,
) -> DataFrame:
    """As :func:`split`, with exact sizes (shares rounded up), overall or within each label."""
    strata = [stratify] if stratify else []

    def share(f: float) -> Callable[[Column], Column]:
        return lambda n: F.ceil(n * F.lit(float(f)))

    cut = _hash_cut(df, key, f"{seed}/test", share(test), strata)
    out = _mark_first(df, key, f"{seed}/test", cut, strata, "_test")
    rest = out.where(~F.col("_test"))
    cut = _hash_cut(rest, key, f"{seed}/val", share(val), strata)
    # the second cut is right for the rest, and not asked of the test rows: one scan gives all
    out = _mark_first(out, key, f"{seed}/val", cut, strata, "_val")
    named = F.when(F.col("_test"), "test").when(F.col("_val"), "val").otherwise("train")
    return out.withColumn("split", named).drop("_test", "_val")
