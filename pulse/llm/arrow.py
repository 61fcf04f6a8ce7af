"""Arrow batches of bounded size, and tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: Rows and bytes that a Python worker gets at once.
BATCH_ROWS = 500
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and make this package importable on the executors.

    The bounds stay in the session, since plans read them when they run: later Python steps of the session get batches of this size too.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` of the rows, by the hash of their key, or all if they are no more.

    Counted first and then cut by a threshold: no task sends the driver more than its share.
    """
    n = df.count()
    return df if n <= rows else df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(rows / n * (1 << 40)))


def fresh(name: str, *taken: list[str]) -> str:
    """A column name that none of the lists holds, whatever its case."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
