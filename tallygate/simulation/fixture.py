"""Transaction messages made from the ``events`` table, some of them broken on purpose.

This stands in for a producer and is no part of the engine: nothing but the registered
queries, the benchmark and the tests uses it.

One message per event, no randomness: everything follows from the event's columns,
so the same messages can be rebuilt in SQL. Every tenth message is faulty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.functions.event_model import CONTRACT
from tallygate.simulation.lifecycle import FAILURE_REASONS, LIFECYCLE_STATUS
from tallygate.sources.messages import TOPIC, envelope

PARTITIONS = 4

# --- Fixed values: what the simulated payloads contain ---------------------
CURRENCIES = ("USD", "INR", "EUR")
PAYMENT_METHODS = ("card", "ach", "wire", "wallet")
TRANSACTION_TYPES = ("purchase", "refund", "payout", "transfer")
LIFECYCLE_OF_EVENT = {
    "signup": "transaction_created",
    "view": "transaction_authorized",
    "click": "transaction_authorized",
    "error": "transaction_failed",
    "purchase": "transaction_settled",
}
DROPPABLE = ("amount", "currency", "status", "event_time", "transaction_id")
UNEXPECTED = '"unexpected_field": {"nested": true}'

# --- Fixed values: payload faults that exercise each contract rule ---------
REQUIRED = tuple(rule.name for rule in CONTRACT if rule.required)
TEXTS = tuple(rule.name for rule in CONTRACT if rule.kind == "string")
INTEGERS = tuple(rule.name for rule in CONTRACT if rule.kind == "integer")
BAD_AMOUNTS = ("-5.00", "1e3", "12.5", ".50", "12.345", "1,000.00")
BAD_CURRENCIES = ("usd", "US", "USDX", "U5D")
BAD_TIMES = (
    "2024-13-01T00:00:00Z",
    "2024-02-30T00:00:00Z",
    "2024-01-01 00:00:00Z",
    "2024-01-01",
    "2024-01-01T24:00:00Z",
    "yesterday",
)
# Spellings the contract allows and a plain cast does not read.
ODD_TIMES = ("%sT23:59:60Z", "%st10:00:00z", "%sT10:00:00+23:59", "%sT10:00:00.5-18:30")
WHOLE_NUMBERS = ("95.0", "9e1", "1e2", "80.0")
CONTRACT_FAULTS = 19


EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt out evenly over the tasks.

    A few bytes of an event become a message of hundreds that is then parsed and judged. How
    many tasks share that work must not hang on the file's row groups: millions of events may
    lie in one.
    """
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return events.hint("rebalance")


# 0 for an intact message, otherwise the kind of damage: 1 a required field
# dropped, 2 amount as a number, 3 a bad code, 4 an unknown field, 5 text cut short.
MODE = "CAST(CASE WHEN event_id % 10 = 0 THEN event_id div 10 % 5 + 1 ELSE 0 END AS int)"

# -1 for an intact message, otherwise which contract fault it has.
FAULT = f"CASE WHEN event_id % 10 = 0 THEN event_id div 10 % {CONTRACT_FAULTS} ELSE -1 END"


def _pick(values: tuple[str, ...], number: str) -> str:
    """values[number % len(values)]"""
    options = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({options}), CAST({number} % {len(values)} AS int) + 1)"


def _quoted(text: str) -> str:
    return f"""concat('"', {text}, '"')"""


def _status() -> str:
    cases = " ".join(
        f"WHEN '{event}' THEN '{LIFECYCLE_STATUS[lifecycle]}'"
        for event, lifecycle in LIFECYCLE_OF_EVENT.items()
    )
    return f"CASE event_type {cases} END"


def _iso(moment: str) -> str:
    return f"""date_format({moment}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""


def _intact() -> dict[str, str]:
    """Field name to its JSON text, for an undamaged message."""
    reason = _quoted(_pick(FAILURE_REASONS, "event_id"))
    return {
        "event_id": _quoted("'evt_', event_id"),
        "transaction_id": _quoted("'txn_', event_id"),
        "user_id": _quoted("'usr_', user_id"),
        "merchant_id": _quoted("'mrc_', user_id % 50"),
        "amount": _quoted("CAST(value AS decimal(18,2))"),
        "currency": _quoted(_pick(CURRENCIES, "event_id")),
        "payment_method": _quoted(_pick(PAYMENT_METHODS, "event_id")),
        "transaction_type": _quoted(_pick(TRANSACTION_TYPES, "event_id div 4")),
        "status": _quoted("status"),
        "failure_reason": f"CASE WHEN status = 'failed' THEN {reason} ELSE 'null' END",
        "event_time": _quoted(_iso("ts")),
        "ingested_at": _quoted(_iso("ts + make_dt_interval(0, 0, 0, event_id % 7)")),
        "risk_score": "CASE WHEN event_id % 13 = 0 THEN 'null' "
        "ELSE CAST(event_id % 101 AS string) END",
        "source_system": _quoted("'sim'"),
        "schema_version": "'1'",
    }


def _body(extra: str) -> str:
    """Fields in order as one JSON object; members whose text is null are left out.

    ``target`` names the field to damage and ``damage`` the JSON text it gets. The
    target "several" damages three fields at once. ``extra`` is an array of members to
    add. (Its array_compact also makes Spark compile this long select by itself, in
    pieces the JVM can optimise.)
    """
    several = {"amount": "NULL", "currency": _quoted("'usd'"), "risk_score": "'101'"}
    members = []
    for name, intact in _intact().items():
        also = f"WHEN target = 'several' THEN {several[name]} " if name in several else ""
        text = f"CASE WHEN target = '{name}' THEN damage {also}ELSE {intact} END"
        members.append(f"""concat('"{name}": ', {text})""")
    return f"concat('{{', concat_ws(', ', {', '.join(members)}, {extra}), '}}')"


def _by(selector: str, outcomes: dict[int, str]) -> str:
    cases = " ".join(f"WHEN {number} THEN {outcome}" for number, outcome in outcomes.items())
    return f"CASE {selector} {cases} END"


_CUT = "substring(body, 1, length(body) - 1)"


def simulated_faults() -> dict[str, str]:
    """The five kinds of damage MODE names."""
    choice = "event_id div 50"
    targets = {1: _pick(DROPPABLE, choice), 2: "'amount'", 3: _pick(("currency", "status"), choice)}
    damages = {
        2: "CAST(CAST(value AS decimal(18,2)) AS string)",
        3: _quoted(_pick(("usd", "authorised"), choice)),
    }
    return {
        "target": _by("mode", targets),
        "damage": _by("mode", damages),
        "extra": f"array_compact(array(CASE WHEN mode = 4 THEN '{UNEXPECTED}' END))",
        "sent": f"CASE WHEN mode = 5 THEN {_CUT} ELSE body END",
    }


def contract_faults() -> dict[str, str]:
    """Faults that between them break every contract rule."""
    choice = f"event_id div {10 * CONTRACT_FAULTS}"
    targets = {
        0: _pick(REQUIRED, choice),
        1: _pick(TEXTS, choice),
        2: _pick(REQUIRED, choice),
        3: _pick(INTEGERS, choice),
        4: _pick(INTEGERS, choice),
        5: _pick(INTEGERS, choice),
        6: "'amount'",
        7: "'currency'",
        8: _pick(("payment_method", "transaction_type", "status"), choice),
        9: "'event_time'",
        10: "'ingested_at'",
        11: "'risk_score'",
        12: "'schema_version'",
        # 13 is one or two unknown fields, 14 spoils the whole text.
        15: "'several'",
        16: "'failure_reason'",
        # 17 and 18 are faults of spelling only: the contract allows them.
        17: "'event_time'",
        18: _pick(INTEGERS, choice),
    }
    odd_times = (_quoted(f"""replace('{time}', '%s', date_format(ts, 'yyyy-MM-dd'))""")
                 for time in ODD_TIMES)
    damages = {
        # 0 drops the field.
        1: "'12.5'",
        2: "'null'",
        3: _quoted("'7'"),
        4: "'80.5'",
        5: "'80.0'",
        6: _quoted(_pick(BAD_AMOUNTS, choice)),
        7: _quoted(_pick(BAD_CURRENCIES, choice)),
        8: _quoted("'unheard_of'"),
        9: _quoted(_pick(BAD_TIMES, choice)),
        10: _quoted(_pick(BAD_TIMES, choice)),
        11: _pick(("-1", "101"), choice),
        12: _pick(("0", "-3"), choice),
        16: f"CASE WHEN status = 'failed' THEN 'null' ELSE {_quoted("'network_error'")} END",
        17: f"element_at(array({', '.join(odd_times)}), CAST({choice} % 4 AS int) + 1)",
        18: f"CASE WHEN target = 'risk_score' THEN {_pick(WHOLE_NUMBERS, f'{choice} div 2')}"
        " ELSE '9999999999' END",
    }
    channel = f"""CASE WHEN fault = 13 AND {choice} % 2 = 1 THEN '"channel": "web"' END"""
    unexpected = f"CASE WHEN fault IN (13, 15) THEN '{UNEXPECTED}' END"
    whole = {0: _CUT, 1: "concat('[', body, ']')", 2: _quoted("'hello'"), 3: "'null'"}
    return {
        "target": _by("fault", targets),
        "damage": _by("fault", damages),
        "extra": f"array_compact(array({channel}, {unexpected}))",
        "sent": f"CASE WHEN fault = 14 THEN {_by(f'({choice}) % 4', whole)} ELSE body END",
    }


FAULTS = {"simulated": simulated_faults, "contract": contract_faults}


def messages_from_events(events: DataFrame, payload: str = "simulated") -> DataFrame:
    """The events as Kafka messages keyed by transaction. Works on a stream too.

    Payloads are written as SQL text: one parse instead of hundreds of small calls.
    """
    faults = FAULTS[payload]()
    return (
        events.selectExpr("*", f"{MODE} AS mode", f"{FAULT} AS fault", f"{_status()} AS status")
        .selectExpr("*", f"{faults['target']} AS target", f"{faults['damage']} AS damage")
        .selectExpr("*", f"{_body(faults['extra'])} AS body")
        .selectExpr(
            "CAST(concat('txn_', event_id) AS binary) AS key",
            f"CAST({faults['sent']} AS binary) AS value",
            f"'{TOPIC}' AS topic",
            f"CAST(event_id % {PARTITIONS} AS int) AS partition",
            "event_id AS offset",
            "CAST(ts AS timestamp) + make_dt_interval(0, 0, 0, event_id % 11) AS timestamp",
            "0 AS timestampType",
        )
    )


def landing_time() -> Column:
    """When a fixture message landed: up to a minute after Kafka had it."""
    return F.col("timestamp") + F.make_dt_interval(secs=F.col("offset") % 60)


def bronze_from_events(events: DataFrame, payload: str = "simulated") -> DataFrame:
    """The events as Bronze rows, with a landing time that is the same on every run."""
    return envelope(messages_from_events(events, payload), landing_time())
