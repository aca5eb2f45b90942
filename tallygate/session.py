"""Session settings the jobs rely on, and where intermediate tables may go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and hours are taken in this zone, on every machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Lets the two-layer write keep one open file per layer and day instead of
    # sorting every task's rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session for spark-submit; master, storage and credentials come from the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir``, or the checkpoint folder that was set on the context."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = folder.get() if folder.isDefined() else None
    return base.rstrip("/") if base else None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A place for an intermediate table that every executor can reach; nothing is there yet.

    It lies under the cluster's checkpoint folder, which must be set: a folder on one machine
    would be lost with it. What is written there is deleted when the session's JVM ends.
    """
    base = shared_base(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{base}/{purpose}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{folder}/data"
