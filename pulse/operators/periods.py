"""Period numbers: the dense rank of the period start over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.periods import period_start


def period_number() -> Column:
    """Dense rank of ``period_date`` from 1, for frames already reduced to a few rows per period.

    Unpartitioned on purpose: never apply it to unreduced rows.
    """
    return F.dense_rank().over(W.orderBy("period_date")).cast("int")


def with_period(df: DataFrame, ts_col: str = "comment_created", period: str = "W") -> DataFrame:
    """Add ``period_date`` and ``period_int`` to every row.

    The rank is taken over the distinct period starts and joined back; the rows themselves are
    neither sorted nor gathered, and nothing runs before the result is asked for. The starts are
    broadcast: a calendar bounds them, a thousand years of days being 365,000 rows of 8 bytes.
    Rows without a timestamp stay, with null period columns.
    """
    dated = df.drop("period_int").withColumn("period_date", period_start(F.col(ts_col), period))
    starts = dated.select("period_date").where(F.col("period_date").isNotNull()).distinct()
    numbered = starts.withColumn("period_int", period_number())
    return dated.join(F.broadcast(numbered), "period_date", "left").select(*dated.columns, "period_int")
