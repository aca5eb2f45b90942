"""Layer tables on any file system Spark can reach, and the CSV export.

Paths are the caller's. Credentials and endpoints belong in the cluster's Hadoop
configuration, never here.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_table(df: DataFrame, path: str, *partition_by: str) -> None:
    refuse_streamed(df.sparkSession, path)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, unless there is one: a stream can only follow a folder that exists."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


def refuse_streamed(spark: SparkSession, path: str) -> None:
    """A stream's sink keeps a log that readers obey: rows added past it are never seen."""
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream; batch rows there would be invisible")


def append_stream(
    df: DataFrame, path: str, checkpoint: str, until_drained: bool, *partition_by: str
) -> StreamingQuery:
    """Append a stream to a Parquet table, each row once across restarts and retries.

    That rests on the checkpoint and the sink's file log, so both paths must be durable.
    With ``until_drained`` the query ends when it has caught up; otherwise it runs until
    stopped.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    if until_drained:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def each_batch(
    df: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    until_drained: bool,
) -> StreamingQuery:
    """Run ``work`` on every micro-batch and its number.

    After a failure the last batch may come again under the same number: ``work`` must
    then replace what it wrote before.
    """
    writer = df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if until_drained:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def overwrite_table(df: DataFrame, path: str, *partition_by: str) -> None:
    refuse_streamed(df.sparkSession, path)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace only the partitions ``df`` has rows for; running it twice changes nothing."""
    refuse_streamed(df.sparkSession, path)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def bronze_of_days(spark: SparkSession, path: str, days: list[datetime.date]) -> DataFrame:
    """Bronze of the landing days listed; other days' files are not opened."""
    return read_table(spark, path).filter(F.col("ingest_date").isin(days))


def bronze_days(
    spark: SparkSession,
    path: str,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> DataFrame:
    """Bronze of the landing days first..last; other days' files are not opened."""
    bronze = read_table(spark, path)
    if first is not None:
        bronze = bronze.filter(F.col("ingest_date") >= F.lit(first))
    if last is not None:
        bronze = bronze.filter(F.col("ingest_date") <= F.lit(last))
    return bronze


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line in every part file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
