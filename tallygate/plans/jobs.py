"""The batch jobs: Bronze to Silver and Quarantine, Silver to Gold, reports on each."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.operators import checks, gate, gold, offsets
from tallygate.plans import lake
from tallygate.sources import tables


def split_days(
    bronze_slice: DataFrame, path: str, gate_name: str = "lenient", as_of: Column | None = None
) -> None:
    """Judge whole landing days of Bronze and replace these days in ``path``.

    One write for both sides: Bronze is read once and every message parsed once. A day is
    one partition with both sides in its files, sorted so that a reader of one side skips
    the other's row groups. So a day is replaced as a whole, whatever gate judged it
    before, and running the job again changes nothing. Give it complete days.
    """
    gated = gate.GATES[gate_name](bronze_slice)
    rows = gate.labelled(gated, as_of).withColumn("ingest_date", F.to_date("bronze_ingested_at"))
    tables.overwrite_partitions(
        rows.sortWithinPartitions("ingest_date", "layer"), path, "ingest_date"
    )


def load_new_days(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    gate_name: str = "lenient",
    as_of: Column | None = None,
) -> list[datetime.date]:
    """Split the landing days whose messages are not all in ``path`` yet; returns them.

    Days are compared by the sets of their offsets, so no message text is read for it and none
    is shuffled; Bronze is then read by a list of days, a filter on its partitions.
    """
    wanted = offsets.intervals(tables.read_table(spark, bronze_path))
    loaded = None
    if tables.exists(spark, path):
        loaded = offsets.intervals(tables.read_table(spark, path))
    days = offsets.days_due(wanted, loaded)
    if days:
        split_days(tables.bronze_of_days(spark, bronze_path, days), path, gate_name, as_of)
    return days


def read_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Silver or Quarantine out of a lake, or a split written by the job or by the stream."""
    if lake.is_lake(spark, path):
        return layer_of(lake.rows(spark, path), layer)
    return layer_of(tables.read_table(spark, path), layer)


def layer_of(rows: DataFrame, layer: str) -> DataFrame:
    """One side of labelled rows."""
    columns = {
        "silver": gate.SILVER_COLUMNS,
        "quarantine": (*gate.QUARANTINE_COLUMNS, "reasons"),
    }[layer]
    return rows.filter(F.col("layer") == layer).select(*columns)


def build_gold(
    silver: DataFrame, path: str, amounts: str = "decimal", date_basis: str = "written"
) -> None:
    """Replace the Gold table with the daily metrics of all of Silver."""
    if lake.is_lake(silver.sparkSession, path):
        raise ValueError(f"{path} is a lake, whose loads keep Gold; build it in another place")
    tables.overwrite_table(gold.daily_metrics(silver, date_basis, amounts), path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold of a lake, or of a folder that ``build_gold`` wrote."""
    if lake.is_lake(spark, path):
        return lake.gold_rows(spark, path)
    return tables.read_table(spark, path).select(*gold.GOLD_COLUMNS)


def scan_layers(
    silver: DataFrame,
    quarantine: DataFrame,
    gold_rows: DataFrame,
    as_of: Column | None = None,
    bad_rows_expected: bool = True,
) -> DataFrame:
    """The full check report over all three layers.

    ``bad_rows_expected``: whether Quarantine must hold rows, as it must where bad data is
    known to have come in (``quarantine_is_due``).
    """
    return checks.scan_all(
        {
            checks.SILVER: (
                gate.typed(silver),
                checks.SILVER_CHECKS + checks.FRESHNESS_CHECKS,
            ),
            checks.QUARANTINE: (quarantine, checks.quarantine_checks(bad_rows_expected)),
            checks.GOLD: (gold_rows, checks.GOLD_CHECKS),
        },
        as_of,
    )


def quarantine_is_due(bronze: DataFrame, silver: DataFrame) -> bool:
    """Whether messages that came in did not pass, so that Quarantine must have them."""
    return bronze.count() > silver.count()
