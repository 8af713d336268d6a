"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Paths of stored tables by application.
_stored: dict[str, list[str]] = {}


def build_session(master: str | None = None, app_name: str = "scriptorium", **conf) -> SparkSession:
    """A session with the settings the operators count on.

    AQE carries most of the run-time work: it merges small shuffle partitions, splits skewed
    join partitions and turns a join into a broadcast once the real size is known to be small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to the machine's own temporary folder: on a cluster
    other executors could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="scriptorium-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def few_listings(spark: SparkSession):
    """Folders that are listed for what is read inside are shared out to few tasks: Spark's own way is a task a folder, up to 10,000 tasks."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    own = spark.conf.get(name)
    spark.conf.set(name, str(min(int(own), max(64, 4 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    What is used several times is worked out once and outlives the executors that did it, and
    the planner knows the real size of what it reads back.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forget(stored: DataFrame) -> None:
    """Delete one table that ``store`` returned; what is built on it must have been written."""
    paths = _stored.get(stored.sparkSession.sparkContext.applicationId, [])
    if getattr(stored, "stored_at", None) in paths:
        paths.remove(stored.stored_at)
        _delete(stored.sparkSession, stored.stored_at)


def clear_stored(spark: SparkSession) -> int:
    """Delete the tables that ``store`` wrote in this session so far, and say how many.

    For when the results built on them have been written: DataFrames that still read them fail afterwards.
    """
    paths = _stored.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)
