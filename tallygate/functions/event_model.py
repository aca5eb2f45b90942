"""The transaction event: its parse schema, the lenient rule and the full contract.

Everything here is data. ``functions.contract`` and ``operators.gate`` turn it
into column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldRule:
    """What the contract says about one field of the event."""

    name: str
    kind: str = "string"  # "string" or "integer"
    required: bool = True
    nullable: bool = False
    pattern: str | None = None
    allowed: tuple[str, ...] = ()
    date_time: bool = False
    minimum: int | None = None
    maximum: int | None = None


# --- Fixed values: the event contract, in payload order --------------------
# Patterns use \A and \z because $ would also match before a final newline.
CONTRACT: tuple[FieldRule, ...] = (
    FieldRule("event_id"),
    FieldRule("transaction_id"),
    FieldRule("user_id"),
    FieldRule("merchant_id"),
    FieldRule("amount", pattern=r"\A[0-9]+(\.[0-9]{2})?\z"),
    FieldRule("currency", pattern=r"\A[A-Z]{3}\z"),
    FieldRule("payment_method", allowed=("card", "ach", "wire", "wallet")),
    FieldRule("transaction_type", allowed=("purchase", "refund", "payout", "transfer")),
    FieldRule("status", allowed=("initiated", "authorized", "failed", "settled")),
    FieldRule("failure_reason", required=False, nullable=True),
    FieldRule("event_time", date_time=True),
    FieldRule("ingested_at", date_time=True),
    FieldRule("risk_score", kind="integer", required=False, nullable=True, minimum=0, maximum=100),
    FieldRule("source_system"),
    FieldRule("schema_version", kind="integer", minimum=1),
)

# --- Fixed values: what the lenient gate requires --------------------------
LENIENT_REQUIRED = (
    "event_id",
    "transaction_id",
    "user_id",
    "merchant_id",
    "amount",
    "currency",
    "status",
    "event_time",
)
LENIENT_REASON = "SCHEMA_OR_REQUIRED_FIELD_FAILURE"

# --- Fixed value: a transaction counts as high risk from this score on -----
HIGH_RISK_SCORE = 80

EVENT_FIELDS = tuple(rule.name for rule in CONTRACT)

# Amount and the two event times stay text here: Bronze and Silver keep what
# was written, typed columns are added later (functions.casts).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField(rule.name, T.IntegerType() if rule.kind == "integer" else T.StringType())
        for rule in CONTRACT
    ]
)
