"""Kafka messages and the Bronze envelope kept around each of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygate.functions.casts import stamp

# --- Fixed values: stream defaults -----------------------------------------
TOPIC = "fintech_transactions"
STARTING_OFFSETS = "earliest"
# A demo's intake cap. Never a default: at scale it would make tiny files and fall behind.
DEMO_OFFSETS_PER_TRIGGER = 1000

# What Spark's Kafka source delivers; file sources stand in for it with this schema.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# --- Fixed values: Bronze's columns ----------------------------------------
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_key", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("ingest_hour", T.StringType()),
    ]
)
BRONZE_COLUMNS = tuple(BRONZE_SCHEMA.fieldNames())


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = TOPIC,
    starting_offsets: str = STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages of a topic as a stream. Needs Spark's Kafka connector on the class path.

    A micro-batch takes all there is unless ``max_offsets_per_trigger`` says otherwise.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.options(**(options or {})).load()


def message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same message rows as a stream over a directory of Parquet files."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def envelope(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze rows: the message exactly as it arrived, where it came from, when it landed.

    Nothing is parsed here. Works on a batch or a stream of messages.
    """
    rows = messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        stamp(ingested_at).alias("ingested_at"),
    )
    return with_partition_helpers(rows)


def with_partition_helpers(rows: DataFrame) -> DataFrame:
    """Add the landing day and hour (in the session time zone)."""
    return rows.withColumn("ingest_date", F.to_date("ingested_at")).withColumn(
        "ingest_hour", F.date_format("ingested_at", "yyyy-MM-dd-HH")
    )
