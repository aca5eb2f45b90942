"""All layers as one: a load judges new days and brings Gold up to date, or changes nothing.

Silver and Quarantine (``layers``, by landing day), the offsets they hold (``positions``, by
landing day), what checks have to say of them (``checks``, by landing day), the sums that Gold
is made of (``sums``, by event day) and Gold itself (``gold``, by event day) are tables of one
lake. A load writes folders of its own and publishes them all by one snapshot
(``sources.snapshots``); wherever it dies, readers see the load before, and a rerun does it anew.

Sums are kept by event day, so a load reads those of the event days it touches and no others.
Each load adds a small part to these days; ``FANOUT`` parts of a level are merged into one of
the next, so a day has a number of parts that grows with the logarithm of its loads. A row of
sums counts as long as the load that made it is the one its landing day has now.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallygate.operators import checks, gate, gold, offsets
from tallygate.sources import snapshots, tables
from tallygate.sources.snapshots import NULL, Parts, Snapshot

#: Parts of one level, and of one event day, that are merged into one of the next level.
FANOUT = 8
BATCH, STREAM = "batch", "stream"
Step = Callable[[str], None]


def _nothing(step: str) -> None:
    """Called after each step of a load; tests stop loads here."""


def _day(name: str) -> datetime.date | None:
    return None if name == NULL else datetime.date.fromisoformat(name)


# --- Reading ------------------------------------------------------------------------------------


def is_lake(spark: SparkSession, root: str) -> bool:
    return snapshots.is_kept(spark, root)


def rows(spark: SparkSession, root: str, days: list[datetime.date] | None = None) -> DataFrame:
    """Judged rows of both sides; of some landing days, if they are named."""
    now = snapshots.latest(spark, root)
    parts = now.parts("layers")
    if days is not None:
        parts = {name: own for name, own in parts.items() if _day(name) in days}
    return snapshots.read(spark, root, now, "layers", parts)


def gold_rows(spark: SparkSession, root: str) -> DataFrame:
    now = snapshots.latest(spark, root)
    return snapshots.read(spark, root, now, "gold").select(*gold.GOLD_COLUMNS)


def offset_differences(spark: SparkSession, bronze: DataFrame, root: str) -> DataFrame:
    """Ranges of offsets that Bronze has and the lake has not, or has too often."""
    now, wanted = snapshots.latest(spark, root), offsets.intervals(bronze)
    held = snapshots.read(spark, root, now, "positions") if now.version else wanted.limit(0)
    return offsets.difference(wanted, held)


def conservation(spark: SparkSession, root: str) -> DataFrame:
    """Sizes of the layers as the loads observed them while writing, and of Gold; PASS if nothing
    was lost or made up between them. No message table is read."""
    counts = snapshots.latest(spark, root).facts["counts"].values()
    seen, silver, quarantine = (sum(c[at] for c in counts) for at in range(3))
    counted = gold_rows(spark, root).agg(
        F.coalesce(F.sum("transaction_count"), F.lit(0)).cast("bigint").alias("gold_rows")
    )
    sizes = counted.select(
        F.lit(seen).cast("bigint").alias("bronze_rows"),
        F.lit(silver).cast("bigint").alias("silver_rows"),
        F.lit(quarantine).cast("bigint").alias("quarantine_rows"),
        "gold_rows",
    )
    routed = F.col("bronze_rows") == F.col("silver_rows") + F.col("quarantine_rows")
    counted = F.col("gold_rows") == F.col("silver_rows")
    return sizes.withColumn("outcome", F.when(routed & counted, "PASS").otherwise("FAIL"))


def quarantine_is_due(spark: SparkSession, root: str) -> bool:
    """Whether messages did not pass, by what the loads observed."""
    return any(c[2] for c in snapshots.latest(spark, root).facts["counts"].values())


def _checked(bad_rows_expected: bool = True) -> checks.Datasets:
    """The checks of which every load stores the state of its landing days."""
    return {
        checks.SILVER: (
            F.col("layer") == "silver", checks.SILVER_CHECKS + checks.FRESHNESS_CHECKS
        ),
        checks.QUARANTINE: (
            F.col("layer") == "quarantine", checks.quarantine_checks(bad_rows_expected)
        ),
    }


def scan(spark: SparkSession, root: str, as_of: Column | None = None) -> DataFrame:
    """The full check report, without reading Silver or Quarantine: their checks are merged from
    the states that the loads left, Gold is small."""
    now = snapshots.latest(spark, root)
    states = snapshots.read(spark, root, now, "checks")
    report = checks.scan_states(states, _checked(quarantine_is_due(spark, root)), as_of)
    return report.unionByName(
        checks.scan(checks.GOLD, gold_rows(spark, root), checks.GOLD_CHECKS, as_of)
    )


# --- Loading ------------------------------------------------------------------------------------


def load(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    gate_name: str = "lenient",
    as_of: Column | None = None,
    date_basis: str = "written",
    again: list[datetime.date] = (),
    rebalance: bool = False,
    step: Step = _nothing,
) -> list[datetime.date]:
    """Bring the lake up to date with Bronze; returns the landing days that were judged.

    Those are the days whose offsets in the lake are not exactly Bronze's, and the days
    ``again``. Bronze is read by a list of days; of the others only positions are looked at. A
    load whose two sides do not add up to what Bronze has of a day publishes nothing.
    """
    base = snapshots.latest(spark, root)
    refuse_other_use(base, BATCH, date_basis)
    bronze = tables.read_table(spark, bronze_path)
    wanted = offsets.intervals(bronze).persist()  # some rows for each day
    try:
        known = (
            snapshots.read(spark, root, base, "positions")
            if "positions" in base.schemas
            else None
        )
        days = sorted({*offsets.days_due(wanted, known), *again})
        if not days:
            return []
        sent = {
            row.ingest_date: row.messages
            for row in offsets.message_counts(wanted.filter(F.col("ingest_date").isin(days)))
            .collect()
        }
    finally:
        wanted.unpersist()
    name = snapshots.new_load()
    # The files of Bronze as they were when its offsets were looked at: messages that land
    # meanwhile are the next load's.
    of_days = bronze.filter(F.col("ingest_date").isin(days))
    layers, schemas, written = _split(spark, of_days, root, name, gate_name, as_of, rebalance)
    step("layers")

    judged = snapshots.read(spark, root, Snapshot(schemas=schemas), "layers", layers)
    states = checks.slice_states(gate.typed(judged), _checked(), "ingest_date")
    schemas["checks"] = snapshots.schema_of(states)
    told = snapshots.write(states, root, "checks", name, "ingest_date")
    observed = _sides(snapshots.read(spark, root, Snapshot(schemas=schemas), "checks", told))
    if tuple(map(sum, zip((0, 0), *observed.values()))) != written:
        raise RuntimeError(f"{written} rows were written, {observed} can be read")
    for day in days:
        if sum(observed.get(day, (0, 0))) != sent.get(day, 0):
            raise RuntimeError(
                f"{day}: {sent.get(day, 0)} messages came in, {observed.get(day)} went out"
            )
    step("checks")

    held = offsets.intervals(judged)
    schemas["positions"] = snapshots.schema_of(held)
    positions = snapshots.write(held, root, "positions", name, "ingest_date")
    step("positions")

    sums = gold.partial_metrics(
        judged.filter(F.col("layer") == "silver"), date_basis, ("ingest_date",)
    ).withColumns({"made_by": F.lit(name), "day": F.col("event_date")})
    schemas["sums"] = snapshots.schema_of(sums)
    new_sums = snapshots.write(sums, root, "sums", name, "day")
    step("sums")

    replaced = [str(day) for day in days]
    touches = dict(base.facts.get("touches", {}))
    touched = {*new_sums, *[e for day in replaced for e in touches.get(day, [])]}
    touches.update(_event_days(spark, root, schemas, new_sums, replaced))
    current = {**base.parts("layers"), **{day: layers.get(day, []) for day in replaced}}
    valid = [(_day(day), own[0].load) for day, own in current.items() if own]
    all_sums, new_gold, schemas["gold"] = regild(
        spark, root, name, base, schemas, new_sums, touched, valid, step
    )
    facts = {
        "use": BATCH,
        "date_basis": date_basis,
        "touches": touches,
        "counts": {
            **base.facts.get("counts", {}),
            **{str(day): [sent.get(day, 0), *observed.get(day, (0, 0))] for day in days},
        },
    }
    changed = {
        "layers": current,
        "positions": {
            **base.parts("positions"), **{day: positions.get(day, []) for day in replaced}
        },
        "checks": {**base.parts("checks"), **{day: told.get(day, []) for day in replaced}},
        "sums": all_sums,
        "gold": {**base.parts("gold"), **{day: new_gold.get(day, []) for day in touched}},
    }
    snapshots.publish(spark, root, base.following(changed, schemas, facts))
    step("published")
    return days


def refuse_other_use(base: Snapshot, use: str, date_basis: str) -> None:
    """A lake is kept by batch loads or by one stream, with one meaning of an event's day."""
    if base.version and (base.facts["use"], base.facts["date_basis"]) != (use, date_basis):
        raise ValueError(
            f"this lake is kept by {base.facts['use']} loads with {base.facts['date_basis']} dates"
        )


def _split(spark, bronze_slice, root, name, gate_name, as_of, rebalance):
    """Write both sides of the days: (parts, schemas, rows of either side as the write saw them).

    Map-only, unless the rows are to be rebalanced: then Spark brings those of a day together
    first, a large day in several pieces, so that days come in few files whatever order
    their messages lay in.
    """
    seen = Observation()
    gated = gate.GATES[gate_name](bronze_slice)
    rows = gate.labelled(gated, as_of).withColumn("ingest_date", F.to_date("bronze_ingested_at"))
    if rebalance:
        rows = rows.hint("rebalance", "ingest_date")

    def of(layer: str) -> Column:
        return F.count_if(F.col("layer") == layer).alias(layer)

    watched = rows.observe(seen, of("silver"), of("quarantine"))
    schemas = {"layers": snapshots.schema_of(rows)}
    sorted_rows = watched.sortWithinPartitions("ingest_date", "layer")
    layers = snapshots.write(sorted_rows, root, "layers", name, "ingest_date")
    return layers, schemas, (seen.get["silver"], seen.get["quarantine"])


def _sides(states: DataFrame) -> dict[datetime.date, tuple[int, int]]:
    """Rows of Silver and of Quarantine by landing day: the states of the checks of row counts."""
    counted = states.filter(F.col("check_id").startswith(checks.ROW_COUNT))
    found: dict[datetime.date, dict[str, int]] = {}
    for row in counted.collect():  # two rows for each day of the load
        found.setdefault(row.ingest_date, {})[row.dataset] = row.state
    return {day: (n[checks.SILVER], n[checks.QUARANTINE]) for day, n in found.items()}


def _event_days(spark, root, schemas, new_sums: Parts, landing_days: list[str]) -> dict:
    """Event days that each landing day has rows for: what its next replacement will touch."""
    found: dict[str, list[str]] = {day: [] for day in landing_days}
    sums = snapshots.read(spark, root, Snapshot(schemas=schemas), "sums", new_sums)
    for row in sums.select("ingest_date", "day").distinct().collect():  # days, not rows
        found[str(row.ingest_date)].append(NULL if row.day is None else str(row.day))
    return found


def regild(
    spark: SparkSession,
    root: str,
    name: str,
    base: Snapshot,
    schemas: dict[str, str],
    new_sums: Parts,
    touched: set[str],
    valid: list[tuple] | None = None,
    step: Step = _nothing,
) -> tuple[Parts, Parts, str]:
    """Gold of the touched event days from their sums, and sums with full levels merged.

    ``valid``: the landing days and the loads whose rows count for them; all rows, without it.
    """
    old = base.parts("sums")
    sums = dict(old)
    for day in touched:
        sums[day] = [*old.get(day, []), *new_sums.get(day, [])]
    now = Snapshot(schemas=schemas)

    def counting(parts: Parts) -> DataFrame:
        found = snapshots.read(spark, root, now, "sums", parts)
        if valid is None:
            return found
        makers = spark.createDataFrame(valid, "ingest_date date, made_by string")
        return found.join(makers, ["ingest_date", "made_by"], "left_semi")

    merged = gold.merge_partials(counting({day: sums[day] for day in touched}))
    merged = merged.withColumn("day", F.col("event_date"))
    gilded = snapshots.write(merged, root, "gold", name, "day")
    step("gold")

    level = 0
    while True:
        full = {
            day: [p for p in sums[day] if p.level == level]
            for day in touched
            if sum(p.level == level for p in sums[day]) >= FANOUT
        }
        if not full and not any(p.level > level for day in touched for p in sums[day]):
            break
        if full:
            # A file for each day: sums of a day are rows of landing days, currencies and states.
            whole = counting(full).repartition("day")
            order = snapshots.read(spark, root, now, "sums", {}).columns
            made = snapshots.write(
                whole.select(*order), root, "sums", f"{name}-{level + 1}", "day", level + 1
            )
            for day in full:
                sums[day] = [p for p in sums[day] if p.level != level] + made.get(day, [])
        level += 1
    step("merged")
    return sums, gilded, snapshots.schema_of(merged)
