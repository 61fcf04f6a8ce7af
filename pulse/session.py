"""Session defaults and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a skewed join stays splittable even where the next step could reuse its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rebuilding texts groups many small arrays per task; stay hash based for longer
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(app: str = "pulse", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the engine's defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder every executor can reach.

    The session names it in ``spark.checkpoint.dir``, whatever its master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/pulse/{name}-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written folder when the application ends, whatever file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def whole_tables(spark: SparkSession, pattern: str) -> list[str]:
    """Written folders that match, in order; one whose writer was lost before its end is not among them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(str(f.getPath().getParent()) for f in found or [])


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Only Python scorers need it, and only where the package is not installed on the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="pulse-")) / home.name
    archive = shutil.make_archive(str(base), "zip", root_dir=home.parent, base_dir=home.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
