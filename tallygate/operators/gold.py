"""Daily metrics per currency and status, and sorted previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.functions.casts import (
    approximate_money,
    high_risk,
    money,
    utc_date,
    written_date,
)

GOLD_KEYS = ("event_date", "currency", "status")
GOLD_COLUMNS = (
    *GOLD_KEYS,
    "transaction_count",
    "total_amount",
    "avg_amount",
    "high_risk_txn_count",
)
PREVIEW_ROWS = 50

# --- Fixed values: what the preview of Quarantine shows --------------------
QUARANTINE_PREVIEW = (
    "error_reason",
    "raw_value",
    "event_id",
    "transaction_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "event_time",
)


def transaction_count() -> Column:
    return F.count("*").alias("transaction_count")


def total_amount(amount: Column) -> Column:
    return F.sum(amount).alias("total_amount")


def avg_amount(amount: Column) -> Column:
    # From the exact sum, so the mean does not depend on row order either.
    return F.try_divide(F.sum(amount).cast("double"), F.count(amount)).alias("avg_amount")


def high_risk_count(risk_score: Column) -> Column:
    return F.sum(high_risk(risk_score)).alias("high_risk_txn_count")


def daily_metrics(
    silver_rows: DataFrame, date_basis: str = "written", amounts: str = "decimal"
) -> DataFrame:
    """One row per (event_date, currency, status); null is a group of its own.

    Partial aggregation happens before the one shuffle, so a day or currency that
    holds most of the rows reaches its reducer as one partial row per map task.

    ``amounts="decimal"`` sums exactly. ``amounts="double"`` sums doubles, which
    also takes amounts with more than two decimals, NaN or exponents.
    """
    day = {"written": written_date, "utc": utc_date}[date_basis]
    rows = silver_rows.select(
        day(F.col("event_time")).alias("event_date"),
        "currency",
        "status",
        (money if amounts == "decimal" else approximate_money)(F.col("amount")).alias("amount_num"),
        "risk_score",
    )
    amount = F.col("amount_num")
    mean = avg_amount(amount) if amounts == "decimal" else F.avg(amount).alias("avg_amount")
    return rows.groupBy(*GOLD_KEYS).agg(
        transaction_count(),
        total_amount(amount),
        mean,
        high_risk_count(F.col("risk_score")),
    )


def partial_metrics(
    silver_rows: DataFrame, date_basis: str = "written", slice_columns: tuple[str, ...] = ()
) -> DataFrame:
    """Sums per slice of Silver (a landing day, a micro-batch) and Gold key, to be added up."""
    day = {"written": written_date, "utc": utc_date}[date_basis]
    amount = money(F.col("amount"))
    rows = silver_rows.select(
        *slice_columns,
        day(F.col("event_time")).alias("event_date"),
        "currency",
        "status",
        amount.alias("amount_num"),
        "risk_score",
    )
    return rows.groupBy(*slice_columns, *GOLD_KEYS).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount_num").alias("total_amount"),
        F.count("amount_num").alias("amounts"),
        F.sum(high_risk(F.col("risk_score"))).alias("high_risk_txn_count"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Daily metrics out of the sums of all slices; the same as over all their rows."""
    total = F.sum("total_amount")
    return partials.groupBy(*GOLD_KEYS).agg(
        F.sum("transaction_count").alias("transaction_count"),
        total.alias("total_amount"),
        F.try_divide(total.cast("double"), F.sum("amounts")).alias("avg_amount"),
        F.sum("high_risk_txn_count").alias("high_risk_txn_count"),
    )


def gold_preview(gold: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First rows in key order."""
    return gold.orderBy(*GOLD_KEYS).limit(rows)


def quarantine_preview(quarantined: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First quarantined messages in topic order, with what could be read of them."""
    return (
        quarantined.orderBy("topic", "partition", "offset")
        .limit(rows)
        .select(*QUARANTINE_PREVIEW)
    )
