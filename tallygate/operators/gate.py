"""The quality gate: parse each message once, decide, route.

The verdict is a column. Filtering on columns of a ``from_json`` struct lets
Catalyst push the filter below the parse and repeat the parse for every field it
mentions; ``evaluate_once`` keeps the parse where it is. A job that needs both
sides writes them in one pass (``plans.jobs.split_days``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygate.functions import contract
from tallygate.functions.casts import instant, money, stamp, utc_date, written_date
from tallygate.functions.event_model import (
    CONTRACT,
    EVENT_FIELDS,
    EVENT_SCHEMA,
    LENIENT_REASON,
    LENIENT_REQUIRED,
)

POSITION = ("topic", "partition", "offset")
CARRIED = ("raw_value", *POSITION, "kafka_timestamp", "bronze_ingested_at")
FLATTENED = (*CARRIED, *EVENT_FIELDS)
WHOLE_NUMBERS = tuple(rule.name for rule in CONTRACT if rule.kind == "integer")
SILVER_COLUMNS = (*FLATTENED, "silver_loaded_at")
QUARANTINE_COLUMNS = (*FLATTENED, "error_reason", "quarantined_at")


def evaluate_once(df: DataFrame, struct: Column) -> DataFrame:
    """Add a struct's fields as columns that later filters do not evaluate again.

    ``inline`` of a one-element array is one row in, one row out. Catalyst does not
    move a filter on generated columns below their generator.
    """
    return df.select("*", F.inline(F.array(struct)))


def parse(bronze: DataFrame) -> DataFrame:
    """Bronze plus ``parsed``, the event as a struct."""
    return bronze.withColumn("parsed", F.from_json("raw_value", EVENT_SCHEMA))


def flatten(bronze: DataFrame, **also: Column) -> DataFrame:
    """Message columns and the 15 event fields side by side, parsed once.

    Bronze's ``ingested_at`` becomes ``bronze_ingested_at``: the event has its own. Whole
    numbers are read as 32-bit ones, and kept as bigint, as both gates show them. ``also``
    names further columns to compute from Bronze.
    """
    carried = bronze.select(
        "raw_value",
        *POSITION,
        "kafka_timestamp",
        F.col("ingested_at").alias("bronze_ingested_at"),
        *[column.alias(name) for name, column in also.items()],
    )
    rows = evaluate_once(carried, F.from_json("raw_value", EVENT_SCHEMA))
    return rows.withColumns({name: F.col(name).cast("bigint") for name in WHOLE_NUMBERS})


def missing_required() -> Column:
    """True when any field the lenient gate requires is null; never null itself."""
    return F.expr(" OR ".join(f"{field} IS NULL" for field in LENIENT_REQUIRED))


def lenient_gate(bronze: DataFrame) -> DataFrame:
    """Flattened rows, ``is_bad``, and the one reason code the lenient gate knows."""
    bad = missing_required()
    none = F.array().cast("array<string>")
    return flatten(bronze).withColumns(
        {
            "reasons": F.when(bad, F.array(F.lit(LENIENT_REASON))).otherwise(none),
            "is_bad": bad,
        }
    )


def strict_gate(bronze: DataFrame, conditional: bool = False) -> DataFrame:
    """Flattened rows judged by the full contract, with every reason they failed.

    ``conditional`` also asks for a failure reason exactly when the status is
    failed; the contract states that only in words, so it is off by default.
    """
    read = (
        flatten(bronze, doc=contract.document())
        .withColumn("plain", contract.is_plain(conditional))
        .withColumn("kinds", contract.kinds())
        .withColumns(
            {"broken": contract.broken_rules(conditional), "extra": contract.extra_keys()}
        )
    )
    return _judged(read)


def _judged(read: DataFrame) -> DataFrame:
    """Reasons and verdicts of rows with what they break."""
    judged = evaluate_once(read, F.struct(contract.reasons().alias("reasons")))
    bad = F.size("reasons") > 0
    exact = {
        name: F.when(bad, F.col(name)).otherwise(number)
        for name, number in contract.whole_numbers().items()
    }
    return judged.withColumns(exact).select(*FLATTENED, "reasons", bad.alias("is_bad"))


def versioned_gate(
    bronze: DataFrame, contracts: dict[int, contract.Rules], conditional: bool = False
) -> DataFrame:
    """Rows judged by the contract of the version that each message names.

    ``contracts``: the rules of each version (see ``functions.json_contract``). A message that
    names none of them is judged by the lowest. Fields that the event has not had from the
    beginning are judged, and stay in the raw text; the columns are those of ``strict_gate``.
    """
    known = sorted(contracts)
    rows = flatten(bronze, doc=contract.document()).withColumn("version", contract.version(known))

    def by_version(judge: Callable[[int], Column]) -> Column:
        chosen = F.when(F.col("version") == known[0], judge(known[0]))
        for number in known[1:]:
            chosen = chosen.when(F.col("version") == number, judge(number))
        return chosen

    read = (
        rows.withColumn(
            "plain", by_version(lambda n: contract.is_plain(conditional, contracts[n]))
        )
        .withColumns(
            {f"kinds_{n}": contract.kinds(contracts[n], f"version = {n}") for n in known}
        )
        .withColumns(
            {
                "broken": by_version(
                    lambda n: contract.broken_rules(conditional, contracts[n], f"kinds_{n}")
                ),
                "extra": by_version(lambda n: contract.extra_keys(contracts[n])),
            }
        )
    )
    return _judged(read)


GATES = {
    "lenient": lenient_gate,
    "strict": strict_gate,
    "strict-conditional": partial(strict_gate, conditional=True),
}


def error_reason() -> Column:
    """All reasons of a row as one text."""
    return F.array_join("reasons", ",")


def silver(gated: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The rows that passed."""
    return (
        gated.filter(~F.col("is_bad"))
        .withColumn("silver_loaded_at", stamp(as_of))
        .select(*SILVER_COLUMNS)
    )


def quarantine(gated: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The rows that failed, raw text kept, with why and when."""
    return (
        gated.filter(F.col("is_bad"))
        .withColumn("error_reason", error_reason())
        .withColumn("quarantined_at", stamp(as_of))
        .select(*QUARANTINE_COLUMNS, "reasons")
    )


def labelled(gated: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Both sides in one table, told apart by ``layer``; for a single partitioned write."""
    bad = F.col("is_bad")
    now = stamp(as_of)
    return (
        gated.withColumn("silver_loaded_at", F.when(~bad, now))
        .withColumn("error_reason", F.when(bad, error_reason()))
        .withColumn("quarantined_at", F.when(bad, now))
        .withColumn("layer", F.when(bad, "quarantine").otherwise("silver"))
        .drop("is_bad")
    )


def typed(silver_rows: DataFrame, date_basis: str = "written") -> DataFrame:
    """Silver plus ``amount_num``, ``event_time_ts`` and ``event_date``.

    ``date_basis`` is "written" (the date as it stands in the text) or "utc".
    """
    event_time = F.col("event_time")
    day = {"written": written_date, "utc": utc_date}[date_basis](event_time)
    return (
        silver_rows.withColumn("amount_num", money(F.col("amount")))
        .withColumn("event_time_ts", instant(event_time))
        .withColumn("event_date", day)
    )


def reason_counts(quarantined: DataFrame) -> DataFrame:
    """How many quarantined rows failed for each reason; a row counts once per reason."""
    return (
        quarantined.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("row_count"))
    )


def violations(gated: DataFrame, *prefixes: str) -> DataFrame:
    """One row per message position and broken rule of the given families, e.g. ``MISSING``."""
    family = F.substring_index("reason", ":", 1)
    return gated.select(*POSITION, F.explode("reasons").alias("reason")).filter(
        family.isin(*prefixes)
    )
