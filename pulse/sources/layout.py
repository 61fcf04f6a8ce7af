"""Posts and comments laid out for what is asked of them: joins by post, look-backs by community and day, texts in every row."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard_at_exit, shared_dir

#: Folders by community and day are kept while there are at most so many; each has up to a file per bucket.
MOST_FOLDERS = 512
#: Coarser folders, tried in this order, and the column that a table with them has.
COARSER = ("month", "quarter", "year")
FOLDER = "day_folder"
#: Parquet keeps a column's different values once, in a dictionary, up to 1 MB of them in a row group; so many bytes of
#: texts leave room for parts that get more than others.
TEXTS_PER_PART = 768 << 10


def deal_texts(posts: DataFrame, text_col: str = "selftext", least: int = 1, part_bytes: int = TEXTS_PER_PART) -> DataFrame:
    """Posts dealt out so that the texts of a part, about ``part_bytes``, fit one Parquet dictionary; ``least`` parts at least.

    For results that repeat a post's text in many rows, as :func:`.feed.flatten_posts` does: each file then has
    the text once. Beyond its dictionary a file has it in every row, and pages are compressed by 64 KB at most, in
    which long texts hardly repeat. Parts, and so files, grow with the texts; a text larger than a dictionary is in every row.
    Posts are read twice: for the size of their texts, and to be dealt.
    """
    texts = posts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return posts.repartition(max(least, math.ceil(texts / part_bytes)))


def _land(df: DataFrame, name: str | None, path: str | None, buckets: int, folders: list[str], key: str) -> DataFrame:
    spark = df.sparkSession
    name = name or f"landed_{uuid.uuid4().hex}"
    if path is None:
        path = shared_dir(spark, "landed")
        discard_at_exit(spark, path)
    # one task per bucket: a folder gets at most one file of each
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(*folders) if folders else writer).saveAsTable(name)
    return spark.table(name)


def _folder_unit(posts: DataFrame, community_col: str, most: int) -> str | None:
    """The finest unit of time whose folders, each with a community, are at most ``most``; None if even years are more."""
    days = posts.select(community_col, "day").distinct()
    units = ("day", *COARSER)
    # a row per community and day is counted, and one row of counts comes back
    n = days.agg(*[F.count_distinct(F.struct(community_col, F.trunc("day", u) if u != "day" else F.col("day"))).alias(u) for u in units]).first()
    return next((u for u in units if n[u] <= most), None)


def land_posts(
    posts: DataFrame, buckets: int, name: str | None = None, path: str | None = None,
    community_col: str = "community", ts_col: str = "created", key: str = "post_id", most_folders: int = MOST_FOLDERS,
) -> DataFrame:
    """Write posts in folders by community and ``day``, and in each by buckets of the post; return the table.

    Joins with comments of as many buckets need no exchange, and a look-back reads its days only
    (:func:`.topn.top_posts` with ``day_col="day"``). Without a ``path`` the table goes when the application ends. A null
    community or time has a folder of its own.

    Every folder holds up to a file per bucket, so a table of many days would fall into very many tiny files. Beyond ``most_folders``
    folders are those of a month, a quarter or a year, whichever comes first below it (``day_folder``, its first
    day); ``day`` is then a column like others, whose metadata names the unit, and a look-back reads the
    folders that hold its days. With more communities than that, folders are years alone.
    Posts are read twice: for their days, and to be written.
    """
    dated = posts.withColumn("day", F.col(ts_col).cast("date"))
    unit = _folder_unit(dated, community_col, most_folders)
    if unit == "day":
        return _land(dated, name, path, buckets, [community_col, "day"], key)
    coarse = dated.withColumn("day", F.col("day").alias("day", metadata={"folder": unit or "year"}))
    placed = coarse.withColumn(FOLDER, F.trunc("day", unit or "year"))
    return _land(placed, name, path, buckets, [community_col, FOLDER] if unit else [FOLDER], key)


def land_comments(comments: DataFrame, buckets: int, name: str | None = None, path: str | None = None, key: str = "post_id") -> DataFrame:
    """Write comments by buckets of their post; return the table. ``buckets`` must be those of the posts."""
    return _land(comments, name, path, buckets, [], key)
