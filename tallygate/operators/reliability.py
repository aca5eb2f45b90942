"""What makes a rerun, a replay or a stalled layer visible or harmless."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygate.operators.gate import POSITION

#: Milliseconds of a bucket of lags.
COARSE = 1 << 16


def conservation(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, gold: DataFrame
) -> DataFrame:
    """One row of layer sizes and whether nothing was lost or made up between them.

    Bronze must equal Silver plus Quarantine, and Gold's counts must add up to Silver.
    """
    counts = [
        bronze.select(F.lit("bronze").alias("layer"), F.lit(1).alias("n")),
        silver.select(F.lit("silver").alias("layer"), F.lit(1).alias("n")),
        quarantine.select(F.lit("quarantine").alias("layer"), F.lit(1).alias("n")),
        gold.select(F.lit("gold").alias("layer"), F.col("transaction_count").alias("n")),
    ]

    def size(layer: str):
        total = F.sum(F.when(F.col("layer") == layer, F.col("n")).otherwise(0))
        return F.coalesce(total, F.lit(0)).cast("long").alias(f"{layer}_rows")

    sizes = reduce(DataFrame.unionByName, counts).agg(
        size("bronze"), size("silver"), size("quarantine"), size("gold")
    )
    routed = F.col("bronze_rows") == F.col("silver_rows") + F.col("quarantine_rows")
    counted = F.col("gold_rows") == F.col("silver_rows")
    return sizes.withColumn("outcome", F.when(routed & counted, "PASS").otherwise("FAIL"))


def first_deliveries(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event: its earliest message.

    Spark keeps the first row per key within each map task before it shuffles
    (WindowGroupLimit), so an event that was sent millions of times reaches its
    reducer as at most one row per map task.
    """
    in_order = Window.partitionBy(key).orderBy(*POSITION)
    return (
        rows.withColumn("delivery", F.row_number().over(in_order))
        .filter(F.col("delivery") == 1)
        .drop("delivery")
    )


def layer_lag(typed_silver: DataFrame, rank: float = 0.95) -> DataFrame:
    """Seconds from event to Kafka, to Bronze and to Silver, per topic.

    The percentile is found in two passes: rows are counted by lag in coarse buckets, which
    every map task does for its own; then, of the bucket that holds the rank, by millisecond. So
    what is put in order is a list of buckets and at most ``COARSE`` milliseconds of one, however
    many messages a topic has and however far its lags are spread.
    """
    stages = {
        "event_to_kafka": ("event_time_ts", "kafka_timestamp"),
        "kafka_to_bronze": ("kafka_timestamp", "bronze_ingested_at"),
        "bronze_to_silver": ("bronze_ingested_at", "silver_loaded_at"),
    }
    lags = typed_silver.select(
        "topic",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(stage).alias("stage"),
                        (F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))).alias("micros"),
                    )
                    for stage, (start, end) in stages.items()
                ]
            )
        ),
    )
    group, millis = ["topic", "stage"], F.expr("micros div 1000")
    counted = lags.groupBy(*group, F.floor(millis / COARSE).alias("bucket")).agg(
        F.count("*").alias("n"),
        F.count("micros").alias("known"),
        F.sum(F.col("micros").cast("decimal(38,0)")).alias("micros"),
        F.max("micros").alias("most"),
    )
    placed = _placed(counted, group, "bucket", rank)
    wanted = placed.filter("before < wanted AND before + known >= wanted")
    # The second pass counts the milliseconds of those buckets only: one of each topic and stage.
    within = (
        lags.withColumns({"millis": millis, "bucket": F.floor(millis / COARSE)})
        .join(wanted.select(*group, "bucket"), [*group, "bucket"], "left_semi")
        .groupBy(*group, "millis")
        .agg(F.count("micros").alias("own"))
    )
    reached = (
        within.join(wanted.select(*group, "before", "wanted"), group)
        .withColumn(
            "so_far",
            F.col("before")
            + F.sum("own").over(Window.partitionBy(*group).orderBy("millis")),
        )
        .filter("so_far >= wanted")
        .groupBy(*group)
        .agg(F.min("millis").alias("at_rank"))
    )
    known = F.sum("known")
    per_stage = counted.groupBy(*group).agg(
        F.sum("n").alias("n"),
        known.alias("known"),
        (F.sum("micros").cast("double") / F.nullif(known, F.lit(0)) / 1e6).alias("mean"),
        F.max("most").alias("most"),
    ).alias("s")
    same = F.col("s.topic").eqNullSafe(F.col("r.topic")) & (F.col("s.stage") == F.col("r.stage"))
    measured = per_stage.join(reached.alias("r"), same, "left").select("s.*", "r.at_rank")
    first = next(iter(stages))
    measures = [F.sum(F.when(F.col("stage") == first, F.col("n"))).alias("row_count")]
    for stage in stages:
        own = F.col("stage") == stage
        measures += [
            F.round(F.max(F.when(own, F.col("mean"))), 3).alias(f"{stage}_avg"),
            (F.max(F.when(own, F.col("at_rank"))) / 1e3).alias(f"{stage}_p95"),
            (F.max(F.when(own, F.col("most"))) / 1e6).alias(f"{stage}_max"),
        ]
    return measured.groupBy("topic").agg(*measures)


def _placed(counted: DataFrame, group: list[str], by: str, rank: float) -> DataFrame:
    """Counts with how many come before them in their group, and which place is looked for."""
    whole = Window.partitionBy(*group)
    before = whole.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counted.filter(F.col(by).isNotNull()).withColumns(
        {
            "before": F.coalesce(F.sum("known").over(before), F.lit(0)),
            "wanted": F.sum("known").over(whole) * rank,
        }
    )
