"""Transaction lifecycle: the status a lifecycle event leaves a transaction in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: lifecycle event type and the status it leads to ---------
LIFECYCLE_STATUS = {
    "transaction_created": "initiated",
    "transaction_authorized": "authorized",
    "transaction_failed": "failed",
    "transaction_settled": "settled",
    "refund_initiated": "initiated",
    "refund_settled": "settled",
}

# --- Fixed values: reasons a failed transaction may carry ------------------
FAILURE_REASONS = (
    "insufficient_funds",
    "suspected_fraud",
    "network_error",
    "invalid_account",
    "limit_exceeded",
)


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value for a key from a small literal table, null when the key is unknown."""
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def lifecycle_status(event_type: Column) -> Column:
    return lookup(event_type, LIFECYCLE_STATUS)


def is_failure(event_type: Column) -> Column:
    """Only a failed transaction carries a failure reason."""
    return F.coalesce(lifecycle_status(event_type) == "failed", F.lit(False))
