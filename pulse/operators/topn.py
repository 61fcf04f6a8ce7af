"""Top posts and first comments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Look-back names and their intervals.
LOOKBACKS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}


def top_posts(
    df: DataFrame,
    community: str,
    as_of: datetime,
    lookback: str = "month",
    n: int = 10,
    community_col: str = "community",
    ts_col: str = "created",
    score_col: str = "score",
    id_col: str = "post_id",
    day_col: str | None = None,
) -> DataFrame:
    """The ``n`` best-scored posts of a community in the look-back before ``as_of``.

    ``as_of`` is an argument, never the clock, so a rerun gives the same rows. Ties go to the
    smaller id. Both filters reach the scan. ``day_col`` names the day that a table is partitioned by: of
    a table that :func:`.layout.land_posts` wrote, only the folders of the community and its days are read,
    of months, quarters or years if it has those.
    """
    if lookback not in LOOKBACKS:
        raise ValueError(f"lookback must be one of {', '.join(LOOKBACKS)}, not {lookback!r}")
    end = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[ts_col].dataType)
    recent = (F.col(ts_col) > end - F.expr(LOOKBACKS[lookback])) & (F.col(ts_col) <= end)
    posts = df.where((F.col(community_col) == community) & recent)
    if day_col:
        first, last = (end - F.expr(LOOKBACKS[lookback])).cast("date"), end.cast("date")
        posts = posts.where(F.col(day_col).between(first, last))
        if unit := df.schema[day_col].metadata.get("folder"):
            posts = posts.where(F.col("day_folder").between(F.trunc(first, unit), F.trunc(last, unit)))
    return posts.orderBy(F.desc(score_col), F.asc(id_col)).limit(n)


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, spread: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank in ``rn``.

    ``order`` must be total within a group. A group may hold most of the table: its rows are dealt
    over ``spread`` tasks (by default as many as a shuffle has partitions, so they grow with the cluster),
    each keeps its ``n`` best, and only those meet in one task. For ``n`` up to 1000 the
    optimizer's group limit cuts in the map tasks already; nothing here depends on that.
    """
    if spread is None:
        spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread_rows = df.withColumn("_part", F.spark_partition_id() % spread)
    by_part = W.partitionBy(*group, "_part").orderBy(*order)
    some = spread_rows.withColumn("rn", F.row_number().over(by_part)).where(F.col("rn") <= n)
    by_group = W.partitionBy(*group).orderBy(*order)
    best = some.drop("rn", "_part").withColumn("rn", F.row_number().over(by_group))
    return best.where(F.col("rn") <= n)


def top_n_per_post(
    comments: DataFrame, n: int, order_by: Sequence[Column], post_col: str = "post_id"
) -> DataFrame:
    """The first ``n`` comments of each post.

    The dashboard's request for ``c`` comments corresponds to ``n = c + 2``: both its caller and
    its slice add one.
    """
    return top_n_per_group(comments, [post_col], order_by, n)


def drop_stickied(df: DataFrame, flag_col: str = "stickied") -> DataFrame:
    """Drop pinned comments. Apply it after the slice, so that a post may end up with fewer."""
    return df.where(~F.coalesce(F.col(flag_col), F.lit(False)))
