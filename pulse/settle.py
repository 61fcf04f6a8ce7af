"""Small derived tables that a later join needs: computed once, written, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .session import discard_at_exit, shared_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a table.

    The file sizes tell the optimizer what it is joining: below its broadcast threshold it
    broadcasts, above it shuffles and adaptive execution splits skewed keys. That is why nothing
    in this package forces a broadcast of anything without a stated bound. The table also survives the
    loss of executors, its lineage ends here, and it is deleted when the application ends.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    discard_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
