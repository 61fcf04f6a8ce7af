"""Streams of comments that are pulled again and again: each is taken once, scored by any model, and counted per period.

What a batch yields is written to a folder of its own, named by the batch's number and readable only when whole. A batch that
is repeated after a failure writes the same folder again, so nothing counts twice. Period numbers rank all
periods there are and are therefore a view over the written totals.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.periods import period_start
from ..operators.aggregates import TABLE_LABELS
from ..operators.periods import period_number
from ..operators.scoring import Model, with_predictions
from ..session import delete_folder, whole_tables
from ..settle import settle
from .live import event_time

#: Every so many batches all totals are written anew, and older folders go.
SNAPSHOT = 50
_TOTALS = "period_date date, label string, n long"


# --- each comment once


def first_arrivals(comments: DataFrame, key: str, ts_col: str = "comment_created", delay: str = "7 days") -> DataFrame:
    """Each ``key`` once, however often overlapping pulls bring it.

    A key is remembered for ``delay`` of event time after its comment's; pulls must not reach back further. Rows
    older than that, and rows without a time, are dropped: a late one cannot be told from a repeated one. State is one entry per key of the delay.
    """
    timed = comments.withColumn("_event_time", event_time(comments, ts_col)).where(F.col("_event_time").isNotNull())
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key]).drop("_event_time")


def newer_versions(comments: DataFrame, key: str, version_col: str, ts_col: str = "edited", delay: str = "7 days") -> DataFrame:
    """Each version of each ``key`` once: new comments and edits, without repeats. :func:`latest` makes them a table.

    ``ts_col`` is when a version was made; one is remembered for ``delay`` after that. An old version that arrives after
    a newer one comes out too, and loses in the table. Rows without a time, key or version are dropped. State is one entry per version
    of the delay, and no row leaves the JVM.
    """
    known = comments.where(F.col(key).isNotNull() & F.col(version_col).isNotNull())
    timed = known.withColumn("_event_time", event_time(comments, ts_col)).where(F.col("_event_time").isNotNull())
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key, version_col]).drop("_event_time")


def latest(rows: DataFrame, key: str, version_col: str) -> DataFrame:
    """One row per key: that of the largest version."""
    kept = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*rows.columns), version_col).alias("_row"))
    return kept.select("_row.*")


# --- batches to folders


def run_batches(
    stream: DataFrame, state: str, each: Callable[[DataFrame, int], None], mode: str = "append", **trigger,
) -> None:
    """Run ``each(batch, number)`` over what is there now, or as ``trigger`` says."""
    writer = stream.writeStream.option("checkpointLocation", state).outputMode(mode).foreachBatch(each)
    writer.trigger(**(trigger or {"availableNow": True})).start().awaitTermination()


def _folder(folder: str, number: int) -> str:
    return f"{folder}/batch={number:010d}"


def _batches(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    return [(int(p.rsplit("=", 1)[1]), p) for p in whole_tables(spark, f"{folder}/batch=*")]


def batch_rows(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """All rows that whole batches wrote to ``folder``; none gives an empty table."""
    paths = [p for _, p in _batches(spark, folder)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def score_arrivals(comments: DataFrame, model: Model, folder: str, state: str, text_col: str = "comment_text", **trigger) -> DataFrame:
    """Clean and score comments batch by batch, by any model, and return what was written.

    Within a batch a model may join, group and shuffle as in a batch job.
    """
    spark, schema = comments.sparkSession, []

    def each(batch: DataFrame, number: int) -> None:
        scored = with_predictions(model.apply(model.cleaned(batch, text_col)), names=model.names)
        schema.append(scored.schema)
        scored.write.mode("overwrite").parquet(_folder(folder, number))

    run_batches(comments, state, each, **trigger)
    if not schema:
        each(spark.createDataFrame([], comments.schema), -1)  # a table without rows
    return batch_rows(spark, folder, schema[0])


# --- totals per period


def _totals(spark: SparkSession, batches: list[tuple[int, str]]) -> DataFrame:
    """The newest total of every period and label."""
    from_ = max((n for n, _ in batches if n % SNAPSHOT == 0), default=0)
    paths = [p for n, p in batches if n >= from_]
    if not paths:
        return spark.createDataFrame([], _TOTALS)
    base = paths[0].rsplit("/", 1)[0]
    rows = spark.read.schema(f"{_TOTALS}, batch long").option("basePath", base).parquet(*paths)
    newest = rows.groupBy("period_date").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["period_date", "batch"]).select("period_date", "label", "n")


def add_to_totals(batch: DataFrame, number: int, folder: str, ts_col: str, label_col: str, period: str) -> None:
    """Write the new totals of the periods that the batch touches, late rows included.

    They follow from the folders of earlier batches, so a batch that comes again writes the same. Rows without a time are left out.
    Totals are few rows whatever the stream: periods times labels.
    """
    spark = batch.sparkSession
    earlier = [(n, p) for n, p in _batches(spark, folder) if n < number]
    dated = batch.where(F.col(ts_col).isNotNull()).select(period_start(F.col(ts_col), period).alias("period_date"), F.col(label_col).alias("label"))
    new = settle(dated.groupBy("period_date", "label").agg(F.count(F.lit(1)).alias("n")), "delta")
    old = _totals(spark, earlier)
    if number % SNAPSHOT:
        old = old.join(new.select("period_date").distinct(), "period_date", "left_semi")
    summed = old.unionByName(new).groupBy("period_date", "label").agg(F.sum("n").alias("n"))
    summed.coalesce(1).write.mode("overwrite").parquet(_folder(folder, number))
    # what a snapshot before the last one replaced is needed by no batch that may still be repeated
    snapshots = [n for n, _ in earlier if n % SNAPSHOT == 0]
    for n, path in earlier:
        if snapshots and n < snapshots[-1]:
            delete_folder(spark, path)


def period_view(spark: SparkSession, folder: str, labels: Sequence[str] = TABLE_LABELS, other: str | None = None) -> DataFrame:
    """The period table as :func:`.aggregates.label_pivot` gives it for all rows of the stream so far."""
    totals = _totals(spark, _batches(spark, folder))
    n = F.col("n")
    counts = totals.groupBy("period_date").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == name, n)), F.lit(0)).alias(name) for name in labels],
        F.coalesce(F.sum(F.when(F.col("label").isNotNull(), n)), F.lit(0)).alias("total"))
    rest = sum((F.col(name) for name in labels), F.lit(0).cast("long"))
    extra = [(F.col("total") - rest).alias(other)] if other else []
    numbered = counts.select(period_number().alias("period_int"), "period_date", *labels, *extra, "total")
    return numbered.where(F.col("total") > 0)


def live_job(
    comments: DataFrame, folder: str, model: Model, key: str, text_col: str = "comment_text", ts_col: str = "comment_created",
    period: str = "D", delay: str = "7 days", **trigger,
) -> None:
    """From overlapping pulls to ``folder/scored`` and ``folder/totals``: each comment once, scored by any model, counted per period.

    Read them by :func:`batch_rows` and :func:`period_view`. A call after a failure goes on where the last one stopped.
    """

    def each(batch: DataFrame, number: int) -> None:
        path = _folder(f"{folder}/scored", number)
        scored = with_predictions(model.apply(model.cleaned(batch, text_col)), names=model.names)
        scored.write.mode("overwrite").parquet(path)
        add_to_totals(batch.sparkSession.read.schema(scored.schema).parquet(path), number, f"{folder}/totals", ts_col, "sentiment_labels", period)

    run_batches(first_arrivals(comments, key, ts_col, delay), f"{folder}/state", each, **trigger)
