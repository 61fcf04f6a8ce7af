"""Registry of checked queries, and the stand-in tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over a table folder, with the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, for text work over the given tables.

    Each of them is one file of one row group, so its scan is one task. A step of the checked queries
    only, not of the operators; taken at any size, and by no key, so that plans show every exchange that
    the operators themselves need.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(table(spark, sf, "documents"))


# Events stand in for dated, labelled comments.
LABEL_SQL = """CASE WHEN event_type = 'error' THEN 'negative'
    WHEN event_type IN ('purchase', 'signup') THEN 'positive' ELSE 'neutral' END"""
COMMENTS_SQL = f"""comments AS (
    SELECT event_id, user_id, ts, value, {LABEL_SQL} AS label FROM events)"""


def label_of(event_type: Column) -> Column:
    return (
        F.when(event_type == "error", "negative")
        .when(event_type.isin("purchase", "signup"), "positive")
        .otherwise("neutral")
    )


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("label", label_of(F.col("event_type")))


# Documents, and web pages with their address, stand in for texts with and without URLs.
TEXTS_SQL = """texts AS (
    SELECT doc_id AS id, text FROM documents
    UNION ALL SELECT -1 - page_id AS id, html || ' ' || url || ' seen' AS text FROM pages)"""


def texts(spark: SparkSession, sf: str) -> DataFrame:
    pages = dealt(table(spark, sf, "pages")).select(
        (-1 - F.col("page_id")).alias("id"), F.concat("html", F.lit(" "), "url", F.lit(" seen")).alias("text")
    )
    return documents(spark, sf).select(F.col("doc_id").alias("id"), "text").unionByName(pages)


# Embeddings stand in for logits (their first three cells) and classes (label modulo 3).
LOGITS_SQL = """logits AS (
    SELECT vec_id, label, label % 3 AS y,
        [embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE] AS z FROM embeddings)"""


def logits(spark: SparkSession, sf: str) -> DataFrame:
    cells = F.slice(F.col("embedding"), 1, 3).cast("array<double>")
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", (F.col("label") % 3).alias("y"), cells.alias("z")
    )


def quoted(values) -> str:
    """SQL list of string literals."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')"
