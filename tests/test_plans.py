"""Plan shapes that decide how the jobs behave on a big cluster."""

from __future__ import annotations

import datetime
import re

import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR, plan_text, small_bronze
from tallygate.operators import checks, gate, gold, offsets, reliability
from tallygate.plans import catalog, jobs, lake
from tallygate.sources import snapshots, tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "table")
    tables.append_table(small_bronze(spark), path, "ingest_date")
    return path


def test_filtering_a_gate_does_not_repeat_the_parse(spark, stored):
    bronze = tables.read_table(spark, stored)
    lenient = plan_text(gate.silver(gate.lenient_gate(bronze)))
    assert lenient.count("from_json(") == 1
    assert "Exchange" not in lenient
    for side in (gate.silver, gate.quarantine):
        strict = plan_text(side(gate.strict_gate(bronze)))
        assert strict.count("from_json(") == 1  # in the branch for messages that need a look
        assert strict.count("parseJson(concat([") == 1
        assert "Exchange" not in strict


def test_gold_has_one_shuffle_after_partial_aggregation(spark, stored):
    bronze = tables.read_table(spark, stored)
    plan = plan_text(gold.daily_metrics(gate.silver(gate.lenient_gate(bronze))))
    assert plan.count("Exchange\n") + plan.count("Exchange (") <= 2  # tree line and detail
    assert "partial_sum" in plan
    assert plan.count("hashpartitioning(") == 1


def test_gold_reads_only_the_columns_it_needs(spark, tmp_path):
    path = str(tmp_path / "silver")
    tables.overwrite_table(gate.silver(gate.lenient_gate(small_bronze(spark))), path)
    plan = plan_text(gold.daily_metrics(tables.read_table(spark, path)))
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "raw_value" not in read
    assert read.count(":") - 1 == 5  # amount, currency, status, event_time, risk_score


def test_day_slice_prunes_partitions(spark, stored):
    day = datetime.date(2024, 1, 10)
    plan = plan_text(tables.bronze_days(spark, stored, day, day))
    partition_filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "ingest_date" in partition_filters


def test_preview_is_a_top_k(spark, stored):
    metrics = gold.daily_metrics(gate.silver(gate.lenient_gate(tables.read_table(spark, stored))))
    assert "TakeOrderedAndProject" in plan_text(gold.gold_preview(metrics))


def test_deduplication_limits_each_event_before_the_shuffle(spark, stored):
    silver = gate.silver(gate.lenient_gate(tables.read_table(spark, stored)))
    plan = plan_text(reliability.first_deliveries(silver))
    assert plan.count("WindowGroupLimit") >= 2
    tree = plan[: plan.index("\n\n\n")]
    # Deeper in the tree means earlier: scan, sort, limit, exchange, limit, window.
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_a_scan_is_one_aggregation(spark, stored):
    silver = gate.typed(gate.silver(gate.lenient_gate(tables.read_table(spark, stored))))
    plan = plan_text(checks.scan("silver", silver, checks.SILVER_CHECKS))
    assert plan.count("Scan parquet") == 2  # tree line and detail
    assert "SinglePartition" in plan and "partial_count" in plan


def test_splitting_moves_no_rows(spark, stored):
    """Not for sorting the two sides apart, and not when days are loaded that are new."""
    days = [datetime.date(2024, 1, 10), datetime.date(2024, 1, 11)]
    bronze = tables.bronze_of_days(spark, stored, days)
    for gated in (gate.lenient_gate(bronze), gate.strict_gate(bronze)):
        plan = plan_text(gate.labelled(gated).sortWithinPartitions("layer"))
        assert "Exchange" not in plan
        assert "ingest_date" in next(x for x in plan.splitlines() if "PartitionFilters" in x)


def test_finding_new_days_reads_positions_only(spark, stored, tmp_path, monkeypatch):
    path = str(tmp_path / "layers")
    jobs.split_days(tables.read_table(spark, stored), path)
    plans = []
    frame = type(spark.range(0))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: plans.append(plan_text(df)) or collect(df))
    sets = [offsets.intervals(tables.read_table(spark, place)) for place in (stored, path)]
    days = offsets.days_due(*sets)
    assert days == []
    reads = [line for line in plans[0].splitlines() if line.startswith("ReadSchema")]
    assert len(reads) == 2
    for read in reads:
        assert "raw_value" not in read and "offset" in read
    assert "raw_value" not in plans[0] and "partial_count" in plans[0]
    assert "CartesianProduct" not in plans[0] and "NestedLoop" not in plans[0]


def test_gold_update_reads_only_the_days_given(spark, stored, tmp_path, monkeypatch):
    """A load of one day again: Bronze's other partitions are not opened, nor the sums and Gold of
    event days that it does not touch."""
    root, day = str(tmp_path / "lake"), datetime.date(2024, 1, 10)
    lake.load(spark, stored, root)
    plans = {}
    write = snapshots.write
    monkeypatch.setattr(
        snapshots,
        "write",
        lambda df, *more, **options: plans.setdefault(more[1], plan_text(df))
        and write(df, *more, **options),
    )
    lake.load(spark, stored, root, again=[day])
    filters = next(line for line in plans["layers"].splitlines() if "PartitionFilters" in line)
    assert "ingest_date" in filters
    assert "raw_value" not in plans["sums"] and "raw_value" not in plans["positions"]
    read = set(re.findall(r"day=(\d{4}-\d\d-\d\d)", plans["gold"]))
    touched = set(snapshots.latest(spark, root).facts["touches"][str(day)])
    assert read and read <= touched


def test_lag_is_counted_before_it_is_ranked(spark, stored):
    silver = gate.typed(gate.silver(gate.lenient_gate(tables.read_table(spark, stored))))
    plan = plan_text(reliability.layer_lag(silver))
    assert "percentile" not in plan
    tree = plan[: plan.index("\n\n\n")]
    # Rows are summed up by lag before the first exchange; the window sees the counts.
    assert tree.index("Window") < tree.rindex("Exchange") < tree.rindex("HashAggregate")


def test_one_scan_for_two_layers(spark, stored):
    judged = gate.labelled(gate.lenient_gate(tables.read_table(spark, stored)))
    plan = plan_text(
        checks.scan_together(
            judged,
            {
                "s": (F.col("layer") == "silver", checks.of_metric(checks.SILVER_CHECKS, "row_count")),
                "q": (F.col("layer") == "quarantine", checks.QUARANTINE_CHECKS),
            },
        )
    )
    assert plan.count("from_json(") == 1
    assert plan.count("Scan parquet") == 2  # tree line and detail


def test_no_exchange_before_the_gate(spark):
    """The registered queries read their table as it is, however few pieces it has."""
    for name in ("silver_lenient", "silver_strict", "bronze_parse"):
        assert "Exchange" not in plan_text(catalog.QUERIES[name](spark, SF_DIR))


def test_lag_orders_buckets_and_never_all_milliseconds(spark):
    """Lags from a millisecond to a century: windows see buckets, or one bucket's milliseconds."""
    seconds = F.when(F.col("id") % 2 == 0, F.col("id") % 90).otherwise(F.col("id") * 3_000_000)
    start = F.timestamp_micros(F.lit(0))
    end = F.timestamp_micros((seconds * 1_000_003).cast("bigint"))
    lags = spark.range(1000).select(
        F.lit("t").alias("topic"), start.alias("event_time_ts"), end.alias("kafka_timestamp"),
        end.alias("bronze_ingested_at"), end.alias("silver_loaded_at"),
    )
    for rank in (0.25, 0.5, 0.95, 1.0):
        row = reliability.layer_lag(lags, rank).first()
        exact = sorted(r[0] for r in lags.select(F.unix_millis("kafka_timestamp")).collect())
        place = next(i for i in range(1000) if i + 1 >= 1000 * rank)
        assert row.event_to_kafka_p95 == exact[place] / 1e3
        assert row.kafka_to_bronze_p95 == 0 and row.row_count == 1000
    plan = plan_text(reliability.layer_lag(lags))
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("bucket" in line or "own" in line for line in windows)
    assert "LeftSemi" in plan
