"""Which messages a table holds: exact sets of offsets, as intervals.

A set of offsets is kept as an array of intervals for each topic partition and landing day, so
a day of a billion messages in a row is one interval. Two sets are compared as sets: what is
missing and what is too much comes out as ranges, also where counts and sums agree.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("ingest_date", "topic", "partition")
#: Offsets that are put in order together; a busy topic partition is cut into such blocks.
BLOCK = 1 << 16
#: Stands for a message without an offset; brokers count from 0.
NO_OFFSET = -1


def islands(rows: DataFrame) -> DataFrame:
    """(ingest_date, topic, partition, first, last, copies): runs of offsets without a gap that
    all occur equally often.

    Offsets are counted in every map task, put in order block by block, and then the runs of
    neighbouring blocks are joined: what one task orders is a block or a list of runs, never
    all messages of a topic partition.
    """
    offset = F.coalesce(F.col("offset"), F.lit(NO_OFFSET)).alias("at")
    counted = (
        rows.select(*KEYS, offset).groupBy(*KEYS, "at").agg(F.count("*").alias("copies"))
    )
    block = F.floor(F.col("at") / BLOCK)
    in_block = Window.partitionBy(*KEYS, "block", "copies").orderBy("at")
    runs = (
        counted.withColumn("block", block)
        .withColumn("run", F.col("at") - F.row_number().over(in_block))
        .groupBy(*KEYS, "block", "copies", "run")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
    )
    return _joined(runs.select(*KEYS, "first", "last", "copies"), "copies")


def _joined(runs: DataFrame, *alike: str) -> DataFrame:
    """Runs that follow one another without a gap, and agree in ``alike``, as one."""
    in_order = Window.partitionBy(*KEYS).orderBy("first")
    goes_on = F.lag("last").over(in_order) == F.col("first") - 1
    for name in alike:
        goes_on &= F.lag(name).over(in_order) == F.col(name)
    begun = F.sum(F.when(goes_on, 0).otherwise(1)).over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        runs.withColumn("begun", begun)
        .groupBy(*KEYS, "begun", *alike)
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(*KEYS, "first", "last", *alike)
    )


def intervals(rows: DataFrame) -> DataFrame:
    """(ingest_date, topic, partition, ranges): the offsets of each as an array of intervals."""
    run = F.struct("first", "last", "copies")
    return islands(rows).groupBy(*KEYS).agg(F.sort_array(F.collect_list(run)).alias("ranges"))


def message_counts(sets: DataFrame) -> DataFrame:
    """(ingest_date, messages) of interval sets."""
    size = F.aggregate(
        "ranges",
        F.lit(0).cast("bigint"),
        lambda n, r: n + (r["last"] - r["first"] + 1) * r["copies"],
    )
    return sets.groupBy("ingest_date").agg(F.sum(size).alias("messages"))


def difference(wanted: DataFrame, loaded: DataFrame) -> DataFrame:
    """(ingest_date, topic, partition, first, last, missing, surplus): the ranges of offsets
    that ``wanted`` has more often than ``loaded``, and by how much, or the other way round.

    Both are ``intervals``. Where an interval begins or ends, the copies on each side are added
    up along the offsets; what is compared is a row for each such place.
    """

    def edges(sets: DataFrame, wanted: int, loaded: int) -> DataFrame:
        run = sets.select(*KEYS, F.explode("ranges").alias("run"))
        ends = F.array(
            F.struct(F.col("run.first").alias("at"), F.col("run.copies").alias("n")),
            F.struct((F.col("run.last") + 1).alias("at"), (-F.col("run.copies")).alias("n")),
        )
        return run.select(*KEYS, F.inline(ends)).select(
            *KEYS, "at", (F.col("n") * wanted).alias("w"), (F.col("n") * loaded).alias("l")
        )

    changes = (
        edges(wanted, 1, 0)
        .unionByName(edges(loaded, 0, 1))
        .groupBy(*KEYS, "at")
        .agg(F.sum("w").alias("w"), F.sum("l").alias("l"))
    )
    along = Window.partitionBy(*KEYS).orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    more = F.sum(F.col("w") - F.col("l")).over(so_far)
    ranges = (
        changes.withColumn("more", more)
        .withColumn("last", F.lead("at").over(along) - 1)
        .where("more <> 0")
        .select(
            *KEYS,
            F.col("at").alias("first"),
            "last",
            F.greatest("more", F.lit(0)).alias("missing"),
            F.greatest(-F.col("more"), F.lit(0)).alias("surplus"),
        )
    )
    return _joined(ranges, "missing", "surplus")


def days_due(wanted: DataFrame, loaded: DataFrame | None) -> list[datetime.date]:
    """Landing days of ``wanted`` whose offsets are not exactly those that are loaded.

    Days that only ``loaded`` has are left alone: Bronze may keep fewer days.
    """
    days = wanted.select("ingest_date").distinct()
    if loaded is None:
        return sorted(row.ingest_date for row in days.collect())
    differing = difference(wanted, loaded).select("ingest_date").distinct().collect()
    if not differing:
        return []
    return sorted({row.ingest_date for row in differing} & {row.ingest_date for row in days.collect()})
