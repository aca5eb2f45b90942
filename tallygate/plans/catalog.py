"""Every query by name: a callable from a session and a table folder to a DataFrame.

Each reads the tables in the folder it is given, mostly ``events``, from which the
fixture makes the transaction messages. The operators themselves live elsewhere; a
query here is a short composition of them.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.functions import casts, contract
from tallygate.functions.event_model import CONTRACT, EVENT_FIELDS, LENIENT_REQUIRED, FieldRule
from tallygate.operators import checks, gate, gold, offsets, reliability
from tallygate.plans import jobs, lake
from tallygate.session import shared_folder
from tallygate.simulation import fixture
from tallygate.simulation.lifecycle import is_failure, lifecycle_status, lookup
from tallygate.sources import messages, tables
from tallygate.streaming import daily, landing, splitting

Query = Callable[[SparkSession, str], DataFrame]

# Dates the fixture's queries refer to; events run from 2024-01-01 to 2024-01-30.
SLICE_FIRST = datetime.date(2024, 1, 10)
SLICE_LAST = datetime.date(2024, 1, 16)
LOADED_THROUGH = datetime.date(2024, 1, 20)
REPORT_TIME = "2024-01-31 00:00:00"


# --- Shared starting points -------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str, payload: str = "simulated") -> DataFrame:
    return fixture.bronze_from_events(fixture.event_table(spark, sf_dir), payload)


def _lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.lenient_gate(_bronze(spark, sf_dir))


def _strict(spark: SparkSession, sf_dir: str, payload: str = "contract", **options) -> DataFrame:
    return gate.strict_gate(_bronze(spark, sf_dir, payload), **options)


def _load_time() -> Column:
    """A Silver load time that is the same on every run."""
    return F.col("bronze_ingested_at") + F.make_dt_interval(secs=90 + F.col("offset") % 30)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.silver(_lenient(spark, sf_dir), _load_time())


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.quarantine(_lenient(spark, sf_dir), _load_time())


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_metrics(_silver(spark, sf_dir))


def _report_time() -> Column:
    return F.to_timestamp(F.lit(REPORT_TIME))


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    """Show exact decimals as doubles, the type the results are compared in."""
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _event_columns() -> list[Column]:
    """Position and event fields; the amount by value, as its spelling may differ."""
    shown = [
        casts.money(F.col(name)).cast("double").alias("amount") if name == "amount" else F.col(name)
        for name in EVENT_FIELDS
    ]
    return [F.col("partition"), F.col("offset"), *shown]


# --- Bronze -----------------------------------------------------------------


def bronze_fixture_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.expr(fixture.MODE).alias("mode")
    return (
        _bronze(spark, sf_dir)
        .withColumn("event_id", F.col("offset"))
        .select("offset", mode, "raw_value")
    )


def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir, "contract").select(
        "topic",
        "partition",
        "offset",
        F.unix_micros("kafka_timestamp").alias("kafka_micros"),
        "kafka_key",
        "raw_value",
        F.unix_micros("ingested_at").alias("ingested_micros"),
    )


def bronze_partition_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _bronze(spark, sf_dir)
        .groupBy("ingest_date", "ingest_hour")
        .agg(F.count("*").alias("row_count"))
    )


def _stored_bronze(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "bronze")
    tables.append_table(_bronze(spark, sf_dir), path, "ingest_date")
    return path


def _per_partition(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("topic", "partition").agg(
        F.count("*").alias("row_count"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(F.length("raw_value")).alias("text_length"),
    )


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_partition(tables.read_table(spark, _stored_bronze(spark, sf_dir)))


def bronze_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_bronze(spark, sf_dir)
    return (
        tables.bronze_days(spark, path, SLICE_FIRST, SLICE_LAST)
        .groupBy("ingest_date")
        .agg(F.count("*").alias("row_count"), F.sum("offset").alias("offset_sum"))
    )


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = gate.parse(_bronze(spark, sf_dir, "contract"))
    rows = parsed.select("partition", "offset", "parsed")
    whole = {name: F.col(name).cast("bigint") for name in gate.WHOLE_NUMBERS}
    parsed = gate.evaluate_once(rows, F.col("parsed")).withColumns(whole)
    return parsed.select(*_event_columns())


# --- The gate ---------------------------------------------------------------


def silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.flatten(_bronze(spark, sf_dir)).select("raw_value", *_event_columns())


def required_missing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.flatten(_bronze(spark, sf_dir, "contract")).select(
        "offset",
        *[F.col(name).isNull().alias(f"no_{name}") for name in LENIENT_REQUIRED],
        gate.missing_required().alias("is_bad"),
    )


def silver_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select(*_event_columns())


def quarantine_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).select("raw_value", "error_reason", *_event_columns())


def silver_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.silver(_strict(spark, sf_dir)).select(*_event_columns())


def silver_strict_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the strict gate accepts has a date and an instant, however it is spelled."""
    return gate.typed(gate.silver(_strict(spark, sf_dir))).select(
        "offset", F.unix_micros("event_time_ts").alias("event_time_micros"), "event_date"
    )


def high_risk_count_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.typed(gate.silver(_strict(spark, sf_dir)))
    return rows.groupBy(*gold.GOLD_KEYS).agg(gold.high_risk_count(F.col("risk_score")))


def quarantine_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.quarantine(_strict(spark, sf_dir)).select("offset", "raw_value", "error_reason")


def quarantine_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.reason_counts(gate.quarantine(_strict(spark, sf_dir, "simulated")))


def _contract_rule(*prefixes: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gate.violations(_strict(spark, sf_dir, **options), *prefixes).select(
            "offset", "reason"
        )

    return query


#: Version 2 of the contract, for a query: two currencies, scores to 50, and a new field.
SECOND_VERSION = (
    *[
        replace(rule, allowed=("USD", "EUR")) if rule.name == "currency"
        else replace(rule, maximum=50) if rule.name == "risk_score"
        else rule
        for rule in CONTRACT
    ],
    FieldRule("channel", required=False, allowed=("web", "app")),
)


def contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every broken rule where half the messages name version 2, each judged by its own."""
    second = F.replace("raw_value", F.lit('"schema_version": 1'), F.lit('"schema_version": 2'))
    bronze = _bronze(spark, sf_dir, "contract").withColumn(
        "raw_value", F.when(F.col("offset") % 20 < 10, second).otherwise(F.col("raw_value"))
    )
    gated = gate.versioned_gate(bronze, {1: CONTRACT, 2: SECOND_VERSION})
    return gated.select("offset", F.explode("reasons").alias("reason"))


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.typed(_silver(spark, sf_dir)).select(
        "offset",
        F.col("amount_num").cast("double").alias("amount_num"),
        F.unix_micros("event_time_ts").alias("event_time_micros"),
        "event_date",
    )


def audit_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each row was loaded or set aside; exactly one of the two."""
    judged = gate.labelled(_lenient(spark, sf_dir), _load_time())
    return judged.select(
        "offset",
        "layer",
        F.unix_micros("silver_loaded_at").alias("loaded_micros"),
        F.unix_micros("quarantined_at").alias("quarantined_micros"),
    )


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lifecycle_type = lookup(F.col("event_type"), fixture.LIFECYCLE_OF_EVENT)
    return (
        fixture.event_table(spark, sf_dir)
        .select(
            "event_id",
            lifecycle_type.alias("lifecycle_type"),
            lifecycle_status(lifecycle_type).alias("status"),
            is_failure(lifecycle_type).alias("is_failure"),
        )
    )


# --- Gold -------------------------------------------------------------------


def gold_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(_gold(spark, sf_dir), "total_amount")


def gold_daily_metrics_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = gold.daily_metrics(_silver(spark, sf_dir), amounts="double")
    # Sums of doubles depend on row order in their last digits.
    return metrics.withColumns(
        {"total_amount": F.round("total_amount", 4), "avg_amount": F.round("avg_amount", 8)}
    )


def gold_strict_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = gold.daily_metrics(gate.silver(_strict(spark, sf_dir, "simulated")), "utc")
    return _as_double(metrics, "total_amount")


def _gold_measure(*measures: Callable[[], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = gate.typed(_silver(spark, sf_dir))
        return rows.groupBy(*gold.GOLD_KEYS).agg(*[measure() for measure in measures])

    return query


def gold_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(gold.gold_preview(_gold(spark, sf_dir)), "total_amount")


def quarantine_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(gold.quarantine_preview(_quarantine(spark, sf_dir)), "amount")


# --- Checks -----------------------------------------------------------------


def _stored_layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver, Quarantine and Gold as tables: one pass over Bronze for all that look at them."""
    path, gold_path = shared_folder(spark, "layers"), shared_folder(spark, "gold")
    jobs.split_days(_bronze(spark, sf_dir), path, as_of=_load_time())
    silver = jobs.read_layer(spark, path, "silver")
    jobs.build_gold(silver, gold_path)
    quarantine = jobs.read_layer(spark, path, "quarantine")
    return silver, quarantine, jobs.read_gold(spark, gold_path)


def dq_scan_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.typed(_silver(spark, sf_dir))
    return checks.scan(checks.SILVER, rows, checks.SILVER_CHECKS)


def dq_scan_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.scan(checks.QUARANTINE, _quarantine(spark, sf_dir), checks.QUARANTINE_CHECKS)


def dq_scan_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.scan(checks.GOLD, _gold(spark, sf_dir), checks.GOLD_CHECKS)


def _scan_metric(metric: str) -> Query:
    """One metric on all layers: Silver and Quarantine in one pass over the judged rows."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        judged = gate.typed(gate.labelled(_lenient(spark, sf_dir), _load_time()))
        sides = {
            checks.SILVER: ("silver", checks.SILVER_CHECKS),
            checks.QUARANTINE: ("quarantine", checks.QUARANTINE_CHECKS),
        }
        report = checks.scan_together(
            judged,
            {
                name: (F.col("layer") == layer, checks.of_metric(its_checks, metric))
                for name, (layer, its_checks) in sides.items()
            },
        )
        metrics = gold.daily_metrics(jobs.layer_of(judged, "silver"))
        gold_checks = checks.of_metric(checks.GOLD_CHECKS, metric)
        return report.unionByName(checks.scan(checks.GOLD, metrics, gold_checks))

    return query


def dq_clean_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing bad came in, so nothing is asked of Quarantine but that its rows are whole."""
    events = fixture.event_table(spark, sf_dir)
    # The fixture damages events whose id ends in 0; these ids do not.
    bronze = fixture.bronze_from_events(events.withColumn("event_id", F.col("event_id") * 10 + 1))
    gated = gate.lenient_gate(bronze)
    silver, quarantine = gate.silver(gated, _load_time()), gate.quarantine(gated, _load_time())
    due = jobs.quarantine_is_due(bronze, silver)
    return checks.scan(checks.QUARANTINE, quarantine, checks.quarantine_checks(due))


def dq_scan_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a lake after two loads and a day judged anew: states of days are merged, no
    row of Silver or Quarantine is read for it."""
    bronze_path, root = shared_folder(spark, "bronze"), shared_folder(spark, "lake")
    bronze = _bronze(spark, sf_dir)
    for days in (F.col("ingest_date") > LOADED_THROUGH, F.col("ingest_date") <= LOADED_THROUGH):
        tables.append_table(bronze.filter(days), bronze_path, "ingest_date")
        lake.load(spark, bronze_path, root)
    lake.load(spark, bronze_path, root, again=[SLICE_FIRST])
    return lake.scan(spark, root, _report_time())


def dq_invalid_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that are no number are invalid, as negative ones are."""
    odd = F.expr("CASE offset % 97 WHEN 0 THEN 'NaN' WHEN 1 THEN '-1.00' ELSE amount END")
    rows = _silver(spark, sf_dir).withColumn("amount", odd)
    rows = rows.withColumn("amount_num", casts.approximate_money(F.col("amount")))
    return checks.scan(
        checks.SILVER, rows, checks.of_metric(checks.SILVER_CHECKS, checks.INVALID_COUNT)
    )


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.typed(_silver(spark, sf_dir))
    return checks.scan(checks.SILVER, rows, checks.FRESHNESS_CHECKS, _report_time())


def dq_scan_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = tables.read_table(spark, f"{sf_dir}/customer.parquet")
    balance_checks = (
        checks.Check(checks.ROW_COUNT, ">", 0),
        checks.Check(checks.MISSING_COUNT, "=", 0, "c_acctbal"),
        checks.Check(checks.INVALID_COUNT, "=", 0, "c_acctbal", valid_min=0),
    )
    return checks.scan("customer", customers, balance_checks)


# --- Reliability ------------------------------------------------------------


def layer_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.conservation(_bronze(spark, sf_dir), *_stored_layers(spark, sf_dir))


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load Bronze up to one day, then what is new in it."""
    bronze_path, path = _stored_bronze(spark, sf_dir), shared_folder(spark, "incremental")
    first = tables.bronze_days(spark, bronze_path, last=LOADED_THROUGH)
    jobs.split_days(first, path)
    days = jobs.load_new_days(spark, bronze_path, path)
    rows = tables.read_table(spark, path).filter(F.col("ingest_date").isin(days))
    return jobs.layer_of(rows, "silver").select(*_event_columns())


def layer_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days split twice, by the strict and then the lenient gate: no row is left over."""
    bronze_path, path = _stored_bronze(spark, sf_dir), shared_folder(spark, "replay")
    bronze = tables.read_table(spark, bronze_path)
    for gate_name in ("strict", "lenient", "lenient"):
        jobs.split_days(bronze, path, gate_name)
    return (
        tables.read_table(spark, path)
        .groupBy("layer")
        .agg(F.count("*").alias("row_count"), F.sum("offset").alias("offset_sum"))
    )


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold kept up to date: two loads, and one of the days replayed by another gate and back."""
    bronze_path, root = shared_folder(spark, "bronze"), shared_folder(spark, "lake")
    bronze = _bronze(spark, sf_dir)
    for days in (F.col("ingest_date") <= LOADED_THROUGH, F.col("ingest_date") > LOADED_THROUGH):
        tables.append_table(bronze.filter(days), bronze_path, "ingest_date")
        lake.load(spark, bronze_path, root)
    for gate_name in ("strict", "lenient"):
        lake.load(spark, bronze_path, root, gate_name, again=[SLICE_FIRST])
    return _as_double(jobs.read_gold(spark, root), "total_amount")


class _Died(Exception):
    pass


def load_after_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load and a later one that die after each of their steps in turn and are run again:
    what Silver, Quarantine and Gold then hold of every day."""
    bronze_path, root = shared_folder(spark, "bronze"), shared_folder(spark, "lake")
    bronze = _bronze(spark, sf_dir)

    def dying(at: str) -> Callable[[str], None]:
        def step(done: str) -> None:
            if done == at:
                raise _Died(at)

        return step

    for days, steps in (
        (F.col("ingest_date") <= LOADED_THROUGH, ("layers", "sums", "merged")),
        (F.col("ingest_date") > LOADED_THROUGH, ("positions", "gold", "published")),
    ):
        tables.append_table(bronze.filter(days), bronze_path, "ingest_date")
        for at in steps:
            try:
                lake.load(spark, bronze_path, root, step=dying(at))
            except _Died:
                continue
        lake.load(spark, bronze_path, root)
    sides = lake.rows(spark, root).groupBy("layer", F.col("ingest_date").alias("day"))
    published = lake.gold_rows(spark, root)
    return sides.agg(F.count("*").alias("row_count")).unionByName(
        published.groupBy(F.lit("gold").alias("layer"), F.col("event_date").alias("day")).agg(
            F.sum("transaction_count").alias("row_count")
        )
    )


def _partly_loaded(bronze: DataFrame) -> DataFrame:
    """Of ten offsets in a row of a partition, the fourth and the sixth are lost and the fifth is
    there three times, so that counts and sums are right. In some days' tens, that is."""
    place = F.floor(F.col("offset") / fixture.PARTITIONS) % 10
    struck = F.floor(F.col("offset") / (10 * fixture.PARTITIONS)) % 7 == 0
    times = (
        F.when(struck & place.isin(3, 5), 0).when(struck & (place == 4), 3).otherwise(1).cast("int")
    )
    again = F.explode(F.array_repeat(F.lit(0), times)).alias("again")
    return bronze.select("ingest_date", "topic", "partition", "offset", again).drop("again")


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of Bronze as intervals, without the message texts."""
    return offsets.islands(_bronze(spark, sf_dir)).drop("topic")


def offset_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a table lacks or has too often that agrees with Bronze in counts and sums."""
    bronze = _bronze(spark, sf_dir)
    wanted, loaded = offsets.intervals(bronze), offsets.intervals(_partly_loaded(bronze))
    return offsets.difference(wanted, loaded).drop("topic")


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice; the earlier delivery is kept."""
    again = F.array(F.col("partition"), F.col("partition") + fixture.PARTITIONS)
    twice = _silver(spark, sf_dir).withColumn("partition", F.explode(again))
    return reliability.first_deliveries(twice).select(*_event_columns())


def layer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reliability.layer_lag(gate.typed(_silver(spark, sf_dir)))


def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write both layers and Gold twice, read everything back."""
    path = shared_folder(spark, "layers")
    for _ in range(2):
        jobs.split_days(_bronze(spark, sf_dir), path, as_of=_load_time())
    silver = jobs.read_layer(spark, path, "silver")
    quarantine = jobs.read_layer(spark, path, "quarantine")
    gold_path = shared_folder(spark, "gold")
    for _ in range(2):
        jobs.build_gold(silver, gold_path)
    stored = tables.read_table(spark, gold_path)
    return (
        silver.groupBy(F.lit("silver").alias("layer"))
        .agg(F.count("*").alias("row_count"), F.sum("offset").alias("total"))
        .unionByName(
            quarantine.groupBy(F.lit("quarantine").alias("layer")).agg(
                F.count("*").alias("row_count"), F.sum("offset").alias("total")
            )
        )
        .unionByName(
            stored.groupBy(F.lit("gold").alias("layer")).agg(
                F.count("*").alias("row_count"), F.sum("transaction_count").alias("total")
            )
        )
    )


def gold_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "gold-csv")
    metrics = _gold(spark, sf_dir)
    tables.export_csv(metrics, path)
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in metrics.schema)
    return _as_double(tables.read_csv(spark, path, schema), "total_amount")


# --- Streams ----------------------------------------------------------------


#: Thirds of the month in the order their messages arrive, so that streams see old events
#: after new ones. A trigger takes as many files as one arrival brings, so there are several
#: micro-batches, and as many of them however many files the messages lie in.
ARRIVAL = (2, 0, 1)


def _arrive(spark: SparkSession, sf_dir: str, inbox: str, third: int, copy: int = 0) -> None:
    """One third of the messages, as files in an inbox; copies are on partitions of their own."""
    sent = fixture.messages_from_events(fixture.event_table(spark, sf_dir))
    of_third = F.least((F.dayofmonth("timestamp") - 1).cast("int"), F.lit(29)) / 10
    shifted = F.col("partition") + copy * fixture.PARTITIONS
    tables.append_table(
        sent.filter(F.floor(of_third) == third).withColumn("partition", shifted), inbox
    )


def _inbox(spark: SparkSession, sf_dir: str, copies: tuple[int, ...] = (0,)) -> str:
    path = shared_folder(spark, "inbox")
    for third in ARRIVAL:
        for copy in copies:
            _arrive(spark, sf_dir, path, third, copy)
    return path


def _files_of_one(spark: SparkSession, inbox: str, arrivals: int) -> int:
    """How many files one of so many arrivals has brought, on average."""
    return max(1, math.ceil(len(tables.read_table(spark, inbox).inputFiles()) / arrivals))


def _land(spark: SparkSession, inbox: str, root: str, files: int | None = None) -> str:
    """All that has come; in one micro-batch, unless a trigger takes only some files."""
    landing.land(
        messages.message_files(spark, inbox, max_files_per_trigger=files),
        f"{root}/bronze",
        f"{root}/bronze-checkpoint",
        until_drained=True,
        ingested_at=fixture.landing_time(),
    ).awaitTermination()
    return f"{root}/bronze"


def stream_bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = _inbox(spark, sf_dir)
    files = _files_of_one(spark, inbox, len(ARRIVAL))
    landed = _land(spark, inbox, shared_folder(spark, "stream"), files)
    rows = tables.read_table(spark, landed)
    return rows.select("partition", "offset", "kafka_key", "raw_value", "ingest_date")


def stream_restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped twice, with new messages before each restart and none before the last."""
    inbox, root = shared_folder(spark, "inbox"), shared_folder(spark, "stream")
    for third in ARRIVAL:
        _arrive(spark, sf_dir, inbox, third)
        landed = _land(spark, inbox, root)
    _land(spark, inbox, root)
    return _per_partition(tables.read_table(spark, landed))


def stream_silver_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split as a stream that was started, and stopped, before there was any Bronze."""
    root = shared_folder(spark, "stream")

    def split() -> None:
        splitting.split(
            splitting.bronze_stream(spark, f"{root}/bronze", max_files_per_trigger=25),
            f"{root}/layers",
            f"{root}/checkpoint",
            gate_name="strict",
            until_drained=True,
        ).awaitTermination()

    inbox = shared_folder(spark, "inbox")
    for third in ARRIVAL:
        split()
        _arrive(spark, sf_dir, inbox, third)
        _land(spark, inbox, root)
    split()
    return tables.read_table(spark, f"{root}/layers").select(
        "layer", "error_reason", "raw_value", "offset"
    )


def _silver_stream(spark: SparkSession, inbox: str, files: int | None = None) -> DataFrame:
    stream = messages.message_files(spark, inbox, max_files_per_trigger=files)
    return gate.silver(gate.lenient_gate(messages.envelope(stream, fixture.landing_time())))


def stream_gold_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily Gold kept up to date by a stream, every late row in it."""
    root = shared_folder(spark, "stream")
    inbox = _inbox(spark, sf_dir)
    silver = _silver_stream(spark, inbox, _files_of_one(spark, inbox, len(ARRIVAL)))
    daily.publish(silver, f"{root}/gold", f"{root}/checkpoint", until_drained=True
    ).awaitTermination()
    return _as_double(jobs.read_gold(spark, f"{root}/gold"), "total_amount")


def stream_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sent twice; the stream keeps one message of each."""
    root = shared_folder(spark, "stream")
    inbox = _inbox(spark, sf_dir, copies=(0, 1))
    silver = _silver_stream(spark, inbox, _files_of_one(spark, inbox, 2 * len(ARRIVAL)))
    splitting.keep_first_deliveries(
        silver, f"{root}/once", f"{root}/checkpoint", until_drained=True
    ).awaitTermination()
    # Which of the two messages came first is up to the stream, so no positions here.
    return tables.read_table(spark, f"{root}/once").select(*_event_columns()[2:])


def stream_shifted_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sent again in later micro-batches, each time with its time written for another
    day: the first of them is kept. The stream is stopped when it has taken what was sent, and
    started again when everything has been sent anew."""
    root, inbox = shared_folder(spark, "stream"), shared_folder(spark, "inbox")
    sent = fixture.messages_from_events(fixture.event_table(spark, sf_dir))
    text = F.col("value").cast("string")
    for copy, written in enumerate(("2024-01-", "2024-02-", "2023-12-")):
        shifted = F.replace(text, F.lit('"event_time": "2024-01-'), F.lit(f'"event_time": "{written}'))
        shifted = F.replace(shifted, F.lit('"event_time":"2024-01-'), F.lit(f'"event_time":"{written}'))
        again = sent.withColumn("value", shifted.cast("binary"))
        moved = F.col("partition") + copy * fixture.PARTITIONS
        tables.append_table(again.withColumn("partition", moved), inbox)
        splitting.keep_first_deliveries(
            _silver_stream(spark, inbox), f"{root}/once", f"{root}/checkpoint", until_drained=True
        ).awaitTermination()
    return tables.read_table(spark, f"{root}/once").select(*_event_columns())


# --- Registry ---------------------------------------------------------------

QUERIES: dict[str, Query] = {
    "bronze_fixture_modes": bronze_fixture_modes,
    "bronze_envelope": bronze_envelope,
    "bronze_partition_helpers": bronze_partition_helpers,
    "bronze_scan": bronze_scan,
    "bronze_day_slice": bronze_day_slice,
    "bronze_parse": bronze_parse,
    "silver_flatten": silver_flatten,
    "required_missing_flags": required_missing_flags,
    "silver_lenient": silver_lenient,
    "quarantine_lenient": quarantine_lenient,
    "silver_strict": silver_strict,
    "silver_strict_typed": silver_strict_typed,
    "high_risk_count_strict": high_risk_count_strict,
    "quarantine_strict": quarantine_strict,
    "quarantine_reason_counts": quarantine_reason_counts,
    "contract_malformed": _contract_rule(contract.MALFORMED, contract.ROOT_TYPE),
    "contract_required": _contract_rule(contract.MISSING),
    "contract_types": _contract_rule(contract.TYPE),
    "contract_patterns": _contract_rule(contract.PATTERN),
    "contract_enums": _contract_rule(contract.ENUM),
    "contract_formats": _contract_rule(contract.FORMAT),
    "contract_ranges": _contract_rule(contract.RANGE),
    "contract_extra_keys": _contract_rule(contract.EXTRA),
    "contract_conditional": _contract_rule(contract.COND, conditional=True),
    "contract_versions": contract_versions,
    "silver_typed": silver_typed,
    "audit_stamps": audit_stamps,
    "lifecycle_status": lifecycle,
    "gold_daily_metrics": gold_daily_metrics,
    "gold_daily_metrics_double": gold_daily_metrics_double,
    "gold_strict_metrics": gold_strict_metrics,
    "gold_txn_count": _gold_measure(gold.transaction_count),
    "gold_amount_sum": _gold_measure(
        lambda: F.sum("amount_num").cast("double").alias("total_amount")
    ),
    "gold_amount_avg": _gold_measure(lambda: gold.avg_amount(F.col("amount_num"))),
    "high_risk_count": _gold_measure(lambda: gold.high_risk_count(F.col("risk_score"))),
    "gold_preview": gold_preview,
    "quarantine_preview": quarantine_preview,
    "dq_row_count": _scan_metric(checks.ROW_COUNT),
    "dq_missing_count": _scan_metric(checks.MISSING_COUNT),
    "dq_invalid_min": _scan_metric(checks.INVALID_COUNT),
    "dq_freshness": dq_freshness,
    "dq_scan_silver": dq_scan_silver,
    "dq_scan_quarantine": dq_scan_quarantine,
    "dq_scan_gold": dq_scan_gold,
    "dq_scan_customer": dq_scan_customer,
    "dq_clean_load": dq_clean_load,
    "dq_scan_merged": dq_scan_merged,
    "dq_invalid_nan": dq_invalid_nan,
    "layer_conservation": layer_conservation,
    "silver_incremental": silver_incremental,
    "silver_dedup": silver_dedup,
    "layer_lag": layer_lag,
    "layer_roundtrip": layer_roundtrip,
    "layer_replay": layer_replay,
    "gold_incremental": gold_incremental,
    "load_after_crashes": load_after_crashes,
    "offset_ranges": offset_ranges,
    "offset_differences": offset_differences,
    "gold_csv_export": gold_csv_export,
    "stream_bronze_append": stream_bronze_append,
    "stream_restart_exactly_once": stream_restart_exactly_once,
    "stream_silver_split": stream_silver_split,
    "stream_gold_windowed": stream_gold_windowed,
    "stream_first_deliveries": stream_first_deliveries,
    "stream_shifted_repeats": stream_shifted_repeats,
}
