"""Data-quality checks: a list of checks becomes one aggregation per dataset."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_COUNT, MISSING_COUNT, INVALID_COUNT, FRESHNESS = (
    "row_count",
    "missing_count",
    "invalid_count",
    "freshness",
)
OPERATORS = {
    ">": lambda value, threshold: value > threshold,
    ">=": lambda value, threshold: value >= threshold,
    "<": lambda value, threshold: value < threshold,
    "<=": lambda value, threshold: value <= threshold,
    "=": lambda value, threshold: value == threshold,
    "!=": lambda value, threshold: value != threshold,
}
REPORT_COLUMNS = (
    "dataset",
    "check_id",
    "metric",
    "column_name",
    "op",
    "threshold",
    "value",
    "outcome",
)


@dataclass(frozen=True)
class Check:
    """One metric compared with a threshold; freshness is measured in seconds."""

    metric: str
    op: str
    threshold: float
    column: str | None = None
    valid_min: float | None = None
    valid_max: float | None = None

    @property
    def check_id(self) -> str:
        subject = f"{self.metric}({self.column})" if self.column else self.metric
        return f"{subject} {self.op} {self.threshold:g}"

    def measure(self, as_of: Column | None, rows: Column) -> Column:
        """The metric as an aggregate over the rows where ``rows`` holds.

        Nulls are missing, never invalid; a value that is not a number is invalid.
        """
        if self.metric == ROW_COUNT:
            return F.count_if(rows)
        column = F.col(self.column)
        if self.metric == MISSING_COUNT:
            return F.count_if(rows & column.isNull())
        if self.metric == INVALID_COUNT:
            invalid = F.isnan(column.cast("double"))
            if self.valid_min is not None:
                invalid |= column < self.valid_min
            if self.valid_max is not None:
                invalid |= column > self.valid_max
            return F.count_if(rows & invalid)
        if self.metric == FRESHNESS:
            if as_of is None:
                as_of = F.current_timestamp()
            # Null on an empty dataset, which fails the check.
            latest = F.max(F.when(rows, column))
            return (F.unix_micros(as_of) - F.unix_micros(latest)) / 1e6
        raise ValueError(f"unknown metric {self.metric!r}")

    def state(self, rows: Column) -> Column:
        """What a slice of the rows has to say about the metric, as a whole number that merges
        with those of other slices: counts add up, of times the latest counts."""
        if self.metric == FRESHNESS:
            return F.max(F.when(rows, F.unix_micros(self.column)))
        return self.measure(None, rows)

    def merged(self, state: Column, as_of: Column | None) -> Column:
        """The metric out of the states of all slices."""
        if self.metric == FRESHNESS:
            now = F.current_timestamp() if as_of is None else as_of
            return (F.unix_micros(now) - F.max(state)) / 1e6
        return F.coalesce(F.sum(state), F.lit(0))


# --- Fixed values: the datasets and the checks on each of them -------------
SILVER = "silver_fintech_transactions"
QUARANTINE = "quarantine_fintech_transactions"
GOLD = "gold_daily_transaction_metrics"

SILVER_CHECKS = (
    Check(ROW_COUNT, ">", 0),
    Check(MISSING_COUNT, "=", 0, "transaction_id"),
    Check(MISSING_COUNT, "=", 0, "event_time"),
    Check(MISSING_COUNT, "=", 0, "currency"),
    Check(MISSING_COUNT, "=", 0, "status"),
    Check(INVALID_COUNT, "=", 0, "amount_num", valid_min=0),
)
QUARANTINE_CHECKS = (
    Check(ROW_COUNT, ">", 0),
    Check(MISSING_COUNT, "=", 0, "error_reason"),
    Check(MISSING_COUNT, "=", 0, "raw_value"),
)
GOLD_CHECKS = (
    Check(ROW_COUNT, ">", 0),
    Check(MISSING_COUNT, "=", 0, "event_date"),
    Check(MISSING_COUNT, "=", 0, "currency"),
    Check(MISSING_COUNT, "=", 0, "status"),
    Check(INVALID_COUNT, "=", 0, "transaction_count", valid_min=0),
    Check(INVALID_COUNT, "=", 0, "total_amount", valid_min=0),
    Check(INVALID_COUNT, "=", 0, "avg_amount", valid_min=0),
    Check(INVALID_COUNT, "=", 0, "high_risk_txn_count", valid_min=0),
)
# Meant to fail on old data, to show that alerting works.
FRESHNESS_CHECKS = (Check(FRESHNESS, "<", 3600, "event_time_ts"),)


def quarantine_checks(expect_bad_rows: bool = True) -> tuple[Check, ...]:
    """Quarantine must hold rows only where bad data is known to have come in."""
    if expect_bad_rows:
        return QUARANTINE_CHECKS
    return tuple(check for check in QUARANTINE_CHECKS if check.metric != ROW_COUNT)


def scan(
    name: str, dataset: DataFrame, checks: tuple[Check, ...], as_of: Column | None = None
) -> DataFrame:
    """One PASS/FAIL row per check. All metrics come from a single pass over the dataset."""
    return scan_together(dataset, {name: (F.lit(True), checks)}, as_of)


def scan_together(
    rows: DataFrame,
    datasets: dict[str, tuple[Column, tuple[Check, ...]]],
    as_of: Column | None = None,
) -> DataFrame:
    """The report of several datasets that lie in one table, in a single pass over it.

    Each dataset is the rows where its condition holds.
    """
    listed = _listed(datasets)
    measured = rows.agg(
        *[
            check.measure(as_of, condition).cast("double").alias(f"value_{position}")
            for position, (_, condition, check) in enumerate(listed)
        ]
    )
    return _report(measured, listed)


Datasets = dict[str, tuple[Column, tuple[Check, ...]]]


def _listed(datasets: Datasets) -> list[tuple[str, Column, Check]]:
    return [
        (name, condition, check)
        for name, (condition, checks) in datasets.items()
        for check in checks
    ]


def slice_states(rows: DataFrame, datasets: Datasets, slice_column: str) -> DataFrame:
    """(slice, dataset, check_id, state): one row for each check and slice of the rows, in a single
    pass over them. Stored, they stand for the rows: a scan merges them (``scan_states``)."""
    listed = _listed(datasets)
    states = [check.state(condition).alias(f"s{i}") for i, (_, condition, check) in enumerate(listed)]
    told = [
        F.struct(
            F.lit(name).alias("dataset"),
            F.lit(check.check_id).alias("check_id"),
            F.col(f"s{i}").cast("bigint").alias("state"),
        )
        for i, (name, _, check) in enumerate(listed)
    ]
    return rows.groupBy(slice_column).agg(*states).select(slice_column, F.inline(F.array(*told)))


def scan_states(states: DataFrame, datasets: Datasets, as_of: Column | None = None) -> DataFrame:
    """The report that ``scan_together`` gives of all the rows, out of the states of their slices."""
    listed = _listed(datasets)

    def own(name: str, check: Check) -> Column:
        of_check = (F.col("dataset") == name) & (F.col("check_id") == check.check_id)
        return F.when(of_check, F.col("state"))

    measured = states.agg(
        *[
            check.merged(own(name, check), as_of).cast("double").alias(f"value_{position}")
            for position, (name, _, check) in enumerate(listed)
        ]
    )
    return _report(measured, listed)


def _report(measured: DataFrame, listed: list[tuple[str, Column, Check]]) -> DataFrame:
    """A row for each check out of one row with all their values."""
    report = []
    for position, (name, _, check) in enumerate(listed):
        value = F.col(f"value_{position}")
        holds = F.coalesce(OPERATORS[check.op](value, check.threshold), F.lit(False))
        report.append(
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(check.check_id).alias("check_id"),
                F.lit(check.metric).alias("metric"),
                F.lit(check.column).cast("string").alias("column_name"),
                F.lit(check.op).alias("op"),
                F.lit(float(check.threshold)).alias("threshold"),
                value.alias("value"),
                F.when(holds, "PASS").otherwise("FAIL").alias("outcome"),
            )
        )
    return measured.select(F.inline(F.array(*report)))


def scan_all(
    datasets: dict[str, tuple[DataFrame, tuple[Check, ...]]], as_of: Column | None = None
) -> DataFrame:
    """The reports of several datasets in one table."""
    reports = [scan(name, df, checks, as_of) for name, (df, checks) in datasets.items()]
    return functools.reduce(DataFrame.unionByName, reports)


def of_metric(checks: tuple[Check, ...], metric: str) -> tuple[Check, ...]:
    return tuple(check for check in checks if check.metric == metric)
