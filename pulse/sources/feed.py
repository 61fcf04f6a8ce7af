"""Landed posts and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import epoch_to_string
from .files import read_jsonl

COMMENT = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("stickied", T.BooleanType()),
])
POSTS = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("community", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("comments", T.ArrayType(COMMENT)),
])


def read_posts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed posts, a JSON object per line with its comments nested, as ``(posts, bad)``.

    ``bad`` has the lines that are broken or lack a field of :data:`POSTS`, each with its ``reason``; a comment may lack fields.
    """
    return read_jsonl(spark, path, POSTS)


def flatten_posts(posts: DataFrame, n: int | None = None, zone: str = "UTC") -> DataFrame:
    """Nested posts to one row per comment, post columns repeated.

    With ``n``, only the first ``n`` comments of a post are looked at; pinned ones among them
    are then dropped. Posts without comments give no rows. All within the row, no shuffle.
    """
    comments = F.col("comments") if n is None else F.slice("comments", 1, n)
    shown = F.filter(comments, lambda c: ~F.coalesce(c["stickied"], F.lit(False)))
    # the texts of a post are copied only for comments that are shown
    return posts.select("post_id", "title", "selftext", "created_utc", F.explode(shown).alias("c")).select(
        "post_id",
        F.col("title").alias("post_title"),
        F.col("selftext").alias("post_text"),
        epoch_to_string(F.col("created_utc"), zone).alias("post_created"),
        F.col("c.body").alias("comment_text"),
        epoch_to_string(F.col("c.created_utc"), zone).alias("comment_created"),
    )


def join_posts(posts: DataFrame, comments: DataFrame, post_col: str = "post_id") -> DataFrame:
    """Posts and comments landed as two tables: one row per comment with its post's columns.

    A post with very many comments is left to adaptive skew handling, which splits its
    comments over tasks; the join needs no partitioning afterwards that would forbid it.
    """
    return comments.join(posts, post_col)
