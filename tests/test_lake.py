"""Loads that die, replays, late days, streams and what readers see of them."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_text, rows, small_bronze
from tallygate.operators import gate, gold, offsets
from tallygate.plans import jobs, lake
from tallygate.sources import snapshots, tables

STEPS = ("layers", "checks", "positions", "sums", "gold", "merged")
EARLY = "ingest_date <= '2024-01-10'"
LATE = "ingest_date > '2024-01-10'"


class Killed(Exception):
    pass


def kill_after(step):
    def stop(done):
        if done == step:
            raise Killed(step)

    return stop


def stored(spark, path, bronze):
    tables.append_table(bronze, path, "ingest_date")
    return path


def check(spark, root, bronze, gate_name="lenient"):
    """Everything in the lake is what judging all of Bronze at once gives."""
    judged = lake.rows(spark, root)
    silver = jobs.layer_of(judged, "silver")
    assert judged.select(*gate.POSITION).distinct().count() == judged.count() == bronze.count()
    whole = gate.silver(gate.GATES[gate_name](bronze))
    assert rows(silver.select("offset")) == rows(whole.select("offset"))
    assert rows(lake.gold_rows(spark, root)) == rows(gold.daily_metrics(silver))
    assert lake.conservation(spark, root).first().outcome == "PASS"
    assert lake.offset_differences(spark, bronze, root).isEmpty()


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_dies_is_done_anew(spark, tmp_path, step):
    root, bronze = str(tmp_path / "lake"), small_bronze(spark)
    path = stored(spark, str(tmp_path / "bronze"), bronze.filter(EARLY))
    with pytest.raises(Killed):
        lake.load(spark, path, root, step=kill_after(step))
    assert snapshots.latest(spark, root).version == 0
    assert len(lake.load(spark, path, root)) == 10
    check(spark, root, bronze.filter(EARLY))
    before = rows(lake.gold_rows(spark, root))
    stored(spark, path, bronze.filter(LATE))
    with pytest.raises(Killed):
        lake.load(spark, path, root, "strict", step=kill_after(step))
    # Readers see the load before, all of it.
    assert rows(lake.gold_rows(spark, root)) == before
    assert lake.rows(spark, root).count() == bronze.filter(EARLY).count()
    assert len(lake.load(spark, path, root)) == 20
    assert lake.load(spark, path, root) == []
    check(spark, root, bronze)


def test_days_that_are_gone_from_silver_are_gone_from_gold(spark, tmp_path):
    """A day's messages are judged anew by a gate that passes none for some event days."""
    root, bronze = str(tmp_path / "lake"), small_bronze(spark)
    path = stored(spark, str(tmp_path / "bronze"), bronze)
    lake.load(spark, path, root)
    again = [datetime.date(2024, 1, 4), datetime.date(2024, 1, 5)]
    assert lake.load(spark, path, root, "strict", again=again) == again
    silver = jobs.layer_of(lake.rows(spark, root), "silver")
    assert rows(lake.gold_rows(spark, root)) == rows(gold.daily_metrics(silver))
    lake.load(spark, path, root, again=again)
    check(spark, root, bronze)


def test_same_sums_other_offsets(spark, tmp_path):
    """Two messages swapped for two others with the same count, ends and sum of offsets."""
    schema = "ingest_date date, topic string, partition int, offset bigint"
    day = datetime.date(2024, 1, 1)

    def sets(found):
        return offsets.intervals(
            spark.createDataFrame([(day, "t", 0, o) for o in found], schema).repartition(3)
        )

    one, other = [1, 2, 5, 8, 9], [1, 3, 4, 8, 9]
    assert (sum(one), min(one), max(one)) == (sum(other), min(other), max(other))
    found = offsets.difference(sets(one), sets(other)).drop(*offsets.KEYS)
    assert rows(found) == [(2, 2, 1, 0), (3, 4, 0, 1), (5, 5, 1, 0)]
    assert offsets.days_due(sets(one), sets(other)) == [day]
    assert offsets.days_due(sets(one), sets(one)) == []


@pytest.mark.parametrize("seed", range(4))
def test_offset_sets_against_brute_force(spark, monkeypatch, seed):
    """Any offsets, repeated or missing, in blocks so small that runs cross them."""
    monkeypatch.setattr(offsets, "BLOCK", 4)
    rng = random.Random(seed)
    schema = "ingest_date date, topic string, partition int, offset bigint, text string"

    def made():
        return [
            (datetime.date(2024, 1, rng.randint(1, 2)), rng.choice("tu"), rng.randint(0, 1),
             rng.choice([None, *range(25)]), "x")
            for _ in range(rng.randint(0, 150))
        ]

    def times(some):
        found = {}
        for *key, offset, _ in some:
            at = (*key, -1 if offset is None else offset)
            found[at] = found.get(at, 0) + 1
        return found

    wanted, loaded = made(), made()
    sets = [offsets.intervals(spark.createDataFrame(m, schema).repartition(3)) for m in (wanted, loaded)]
    for one, some in zip(sets, (wanted, loaded)):
        unfolded = {}
        for r in one.collect():
            for run in r.ranges:
                for at in range(run.first, run.last + 1):
                    unfolded[(r.ingest_date, r.topic, r.partition, at)] = run.copies
        assert unfolded == times(some)
        assert sum(r.messages for r in offsets.message_counts(one).collect()) == len(some)
    found = {}
    for r in offsets.difference(*sets).collect():
        for at in range(r.first, r.last + 1):
            found[(r.ingest_date, r.topic, r.partition, at)] = r.missing - r.surplus
    w, l = times(wanted), times(loaded)
    assert found == {
        k: w.get(k, 0) - l.get(k, 0) for k in {*w, *l} if w.get(k, 0) != l.get(k, 0)
    }


def test_many_loads_leave_few_parts(spark, tmp_path, monkeypatch):
    """A load for each landing day: parts of an event day grow with the logarithm, and a load
    reads the sums of its own event days only."""
    monkeypatch.setattr(lake, "FANOUT", 3)
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    bronze = small_bronze(spark).filter("ingest_date <= '2024-01-03'")
    # Every day's messages land in pieces, on 27 later days.
    for piece in range(27):
        landed = F.to_timestamp(F.lit(f"2024-02-{piece + 1:02d} 00:00:00"))
        some = bronze.filter(F.col("offset") % 27 == piece).withColumns(
            {"ingested_at": landed, "ingest_date": F.to_date(landed)}
        )
        stored(spark, path, some)
        if piece % 3 == 2:
            lake.load(spark, path, root)
    now = snapshots.latest(spark, root)
    assert now.version == 9
    levels = {len(parts) for parts in now.parts("sums").values()}
    assert levels <= {1, 2, 3}
    assert {p.level for parts in now.parts("sums").values() for p in parts} >= {2}
    silver = jobs.layer_of(lake.rows(spark, root), "silver")
    assert rows(lake.gold_rows(spark, root)) == rows(gold.daily_metrics(silver))
    one = next(iter(now.parts("sums")))
    plan = plan_text(snapshots.read(spark, root, now, "sums", {one: now.parts("sums")[one]}))
    assert f"day={one}" in plan and plan.count("day=") <= plan.count(f"day={one}") + 1


def test_two_loads_at_once(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = stored(spark, str(tmp_path / "bronze"), small_bronze(spark).filter(EARLY))

    def other(step):
        if step == "gold":
            lake.load(spark, path, root)

    with pytest.raises(RuntimeError, match="there already"):
        lake.load(spark, path, root, step=other)
    check(spark, root, small_bronze(spark).filter(EARLY))


def test_vacuum(spark, tmp_path):
    root = str(tmp_path / "lake")
    bronze = small_bronze(spark).filter(EARLY)
    path = stored(spark, str(tmp_path / "bronze"), bronze)
    with pytest.raises(Killed):
        lake.load(spark, path, root, step=kill_after("gold"))
    lake.load(spark, path, root)
    assert snapshots.vacuum(spark, root) == 0  # too young
    assert snapshots.vacuum(spark, root, older_than_hours=0) == 5
    lake.load(spark, path, root, again=[datetime.date(2024, 1, 4)])
    check(spark, root, bronze)
    snapshots.vacuum(spark, root, keep=1, older_than_hours=0)
    check(spark, root, bronze)


def test_messages_that_get_lost_in_a_load_stop_it(spark, tmp_path, monkeypatch):
    path = stored(spark, str(tmp_path / "bronze"), small_bronze(spark).filter(EARLY))
    whole = gate.GATES["lenient"]
    monkeypatch.setitem(gate.GATES, "lenient", lambda b: whole(b.filter("offset <> 10")))
    with pytest.raises(RuntimeError, match="came in"):
        lake.load(spark, path, str(tmp_path / "lake"))
    assert snapshots.latest(spark, str(tmp_path / "lake")).version == 0


def test_conservation_reads_no_messages(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = stored(spark, str(tmp_path / "bronze"), small_bronze(spark))
    lake.load(spark, path, root)
    report = lake.conservation(spark, root)
    assert tuple(report.first()) == (1000, 960, 40, 960, "PASS")
    assert lake.quarantine_is_due(spark, root)
    plan = plan_text(report)
    assert "/gold/" in plan and "/layers/" not in plan and "bronze/" not in plan


def test_another_date_basis_is_refused(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = stored(spark, str(tmp_path / "bronze"), small_bronze(spark).filter(EARLY))
    lake.load(spark, path, root)
    with pytest.raises(ValueError, match="written dates"):
        lake.load(spark, path, root, date_basis="utc")


def test_nothing_to_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = str(tmp_path / "bronze")
    tables.overwrite_table(small_bronze(spark).limit(0), path)
    assert lake.load(spark, path, root) == []
    assert not lake.is_lake(spark, root)


def test_merged_checks_are_those_of_all_rows(spark, tmp_path):
    """After loads, a replay and a day by another gate; and only new days are read for them."""
    root, path = str(tmp_path / "lake"), str(tmp_path / "bronze")
    bronze, now = small_bronze(spark), F.to_timestamp(F.lit("2024-02-01 00:00:00"))

    def check():
        sides = [jobs.read_layer(spark, root, layer) for layer in ("silver", "quarantine")]
        whole = jobs.scan_layers(*sides, lake.gold_rows(spark, root), now)
        assert rows(lake.scan(spark, root, now)) == rows(whole)

    for days in (EARLY, LATE):
        stored(spark, path, bronze.filter(days))
        lake.load(spark, path, root)
        check()
    lake.load(spark, path, root, "strict", again=[datetime.date(2024, 1, 4)])
    check()
    plan = plan_text(lake.scan(spark, root, now))
    assert "/checks/" in plan and "/layers/" not in plan
    last = snapshots.latest(spark, root)
    loads = {p.load for some in last.parts("checks").values() for p in some}
    newest = last.parts("checks")["2024-01-04"][0].load
    assert len(loads) == 3 and [
        day for day, (p, *_) in last.parts("checks").items() if p.load == newest
    ] == ["2024-01-04"]


def test_rebalanced_days_are_in_few_files(spark, tmp_path):
    path = str(tmp_path / "bronze")
    mixed = small_bronze(spark).withColumn("ingest_date", F.lit("all")).repartition(12)
    days = F.to_date("ingested_at")
    mixed.withColumn("ingest_date", days).write.parquet(path)
    files = {}
    for rebalance in (False, True):
        root = tmp_path / f"lake-{rebalance}"
        lake.load(spark, path, str(root), rebalance=rebalance)
        check(spark, str(root), small_bronze(spark))
        found = list(root.glob("layers/load=*/ingest_date=*/*.parquet"))
        files[rebalance] = len(found) / 30
    assert files[True] <= 2 < files[False]


def test_messages_that_land_during_a_load_are_the_next_ones(spark, tmp_path, monkeypatch):
    root, bronze = str(tmp_path / "lake"), small_bronze(spark).filter(EARLY)
    path = stored(spark, str(tmp_path / "bronze"), bronze.filter("offset % 3 <> 0"))
    split = lake._split

    def while_more_lands(*some):
        stored(spark, path, bronze.filter("offset % 3 = 0"))
        return split(*some)

    monkeypatch.setattr(lake, "_split", while_more_lands)
    assert len(lake.load(spark, path, root)) == 10
    monkeypatch.setattr(lake, "_split", split)
    assert lake.rows(spark, root).count() == bronze.filter("offset % 3 <> 0").count()
    assert len(lake.load(spark, path, root)) == 10
    check(spark, root, bronze)
