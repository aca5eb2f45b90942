"""Bronze to Silver and Quarantine, as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallygate.operators import gate
from tallygate.sources import tables
from tallygate.sources.messages import BRONZE_SCHEMA
from tallygate.sources.tables import append_stream

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bronze_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New Bronze files as they appear; there need not be any yet."""
    tables.make_folder(spark, path)
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def split(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    gate_name: str = "lenient",
    until_drained: bool = False,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Route each message to ``path``/layer=silver or layer=quarantine exactly once.

    Both sides go through one file sink, whose log commits them together: a batch
    that is retried after a failure never shows up twice or on one side only. Read
    the result from ``path`` (``plans.jobs.read_layer``), where Spark honours that log.
    """
    rows = gate.labelled(gate.GATES[gate_name](bronze), as_of)
    return append_stream(rows, path, checkpoint, until_drained, "layer")


def silver_stream(spark: SparkSession, path: str) -> DataFrame:
    """New rows of Silver as ``split`` writes them to ``path``; there need not be any yet."""
    tables.make_folder(spark, path)
    nothing = spark.createDataFrame([], BRONZE_SCHEMA)
    schema = gate.labelled(gate.lenient_gate(nothing)).schema
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.filter(F.col("layer") == "silver").select(*gate.SILVER_COLUMNS)


def keep_first_deliveries(
    rows: DataFrame, path: str, checkpoint: str, until_drained: bool = False
) -> StreamingQuery:
    """Keep one message of every event in ``path``: the first to come, whatever comes later.

    A repeat is a message with the id of one that was kept, whatever day, zone or topic it is
    written for. Ids seen are keyed state in RocksDB, on the executors' disks and in the
    checkpoint: a micro-batch looks up its own ids and reads nothing that was written before.
    There is no watermark, so no repeat is too late and the state grows with the events. Which of
    two messages of one micro-batch is kept is not said. Messages without an id are all kept.
    """
    spark = rows.sparkSession
    position = F.concat_ws("/", F.lit("position"), "topic", "partition", "offset")
    key = F.when(F.col("event_id").isNull(), position).otherwise(F.concat(F.lit("="), "event_id"))
    once = rows.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a stream keeps the settings it is started with
    try:
        return append_stream(once, path, checkpoint, until_drained)
    finally:
        spark.conf.set(STATE_STORE, before)
