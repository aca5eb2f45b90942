"""Streams: same result as batch, once across restarts and retries."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import SF_DIR, rows, small_bronze
from tallygate.operators import gate, gold
from tallygate.plans import catalog, jobs
from tallygate.simulation import fixture
from tallygate.sources import messages, tables
from tallygate.streaming import daily, landing, splitting


@pytest.fixture()
def inbox(spark, tmp_path):
    """Messages as five files, for streams of several micro-batches."""
    path = str(tmp_path / "inbox")
    batch = fixture.messages_from_events(fixture.event_table(spark, SF_DIR))
    batch.repartitionByRange(5, "offset").write.parquet(path)
    return path


def land(spark, inbox, root):
    stream = messages.message_files(spark, inbox, max_files_per_trigger=2)
    query = landing.land(
        stream,
        f"{root}/bronze",
        f"{root}/checkpoint",
        until_drained=True,
        ingested_at=fixture.landing_time(),
    )
    query.awaitTermination()
    return query


def test_landing_equals_batch_over_several_batches(spark, inbox, tmp_path):
    query = land(spark, inbox, tmp_path)
    assert query.lastProgress["batchId"] >= 2
    landed = tables.read_table(spark, f"{tmp_path}/bronze").select(*messages.BRONZE_COLUMNS)
    assert rows(landed) == rows(small_bronze(spark))


def test_restart_takes_up_only_new_files(spark, inbox, tmp_path):
    land(spark, inbox, tmp_path)
    land(spark, inbox, tmp_path)
    assert tables.read_table(spark, f"{tmp_path}/bronze").count() == 1000
    more = fixture.messages_from_events(fixture.event_table(spark, SF_DIR))
    more.withColumn("partition", F.lit(9)).coalesce(1).write.mode("append").parquet(inbox)
    land(spark, inbox, tmp_path)
    assert tables.read_table(spark, f"{tmp_path}/bronze").count() == 2000


def split(spark, root, gate_name):
    splitting.split(
        splitting.bronze_stream(spark, f"{root}/bronze", max_files_per_trigger=40),
        f"{root}/layers-{gate_name}",
        f"{root}/checkpoint-{gate_name}",
        gate_name=gate_name,
        until_drained=True,
        as_of=F.timestamp_micros(F.lit(0)),
    ).awaitTermination()


@pytest.mark.parametrize("gate_name", ["lenient", "strict"])
def test_split_equals_batch(spark, inbox, tmp_path, gate_name):
    land(spark, inbox, tmp_path)
    for _ in range(2):
        split(spark, str(tmp_path), gate_name)
    gated = gate.GATES[gate_name](small_bronze(spark))
    as_of = F.timestamp_micros(F.lit(0))
    path = f"{tmp_path}/layers-{gate_name}"
    assert rows(jobs.read_layer(spark, path, "silver")) == rows(gate.silver(gated, as_of))
    assert rows(jobs.read_layer(spark, path, "quarantine")) == rows(gate.quarantine(gated, as_of))


def test_following_begins_before_there_is_bronze(spark, inbox, tmp_path):
    split(spark, str(tmp_path), "lenient")
    land(spark, inbox, tmp_path)
    split(spark, str(tmp_path), "lenient")
    path = f"{tmp_path}/layers-lenient"
    assert jobs.read_layer(spark, path, "silver").count() == 960
    with pytest.raises(ValueError, match="stream"):
        jobs.split_days(small_bronze(spark), path)


@pytest.fixture()
def late_inbox(spark, tmp_path):
    """Messages in three files, the newest events first."""
    path = str(tmp_path / "late")
    sent = fixture.messages_from_events(fixture.event_table(spark, SF_DIR))
    for first, last in ((21, 31), (1, 10), (11, 20)):
        days = sent.filter(F.dayofmonth("timestamp").between(first, last))
        days.coalesce(1).write.mode("append").parquet(path)
    return path


def silver_stream(spark, inbox, files=1):
    stream = messages.message_files(spark, inbox, max_files_per_trigger=files)
    return gate.silver(gate.lenient_gate(messages.envelope(stream, fixture.landing_time())))


def publish(spark, inbox, root):
    query = daily.publish(
        silver_stream(spark, inbox), f"{root}/gold", f"{root}/cp", True
    )
    query.awaitTermination()
    return query


def test_streamed_gold_has_every_late_row(spark, late_inbox, tmp_path):
    query = publish(spark, late_inbox, tmp_path)
    assert query.lastProgress["batchId"] >= 2
    batch = gold.daily_metrics(gate.silver(gate.lenient_gate(small_bronze(spark))))
    assert rows(jobs.read_gold(spark, f"{tmp_path}/gold")) == rows(batch)
    again = fixture.messages_from_events(fixture.event_table(spark, SF_DIR))
    again.filter("offset < 100").coalesce(1).write.mode("append").parquet(late_inbox)
    publish(spark, late_inbox, tmp_path)
    counted = jobs.read_gold(spark, f"{tmp_path}/gold").agg(F.sum("transaction_count"))
    assert counted.first()[0] == 960 + gate.silver(
        gate.lenient_gate(small_bronze(spark).filter("offset < 100"))
    ).count()


def test_a_micro_batch_that_comes_again_counts_once(spark, late_inbox, tmp_path, monkeypatch):
    """As after a failure between the batch's work and its commit."""
    each = tables.each_batch

    def twice(df, work, *more):
        def both(batch, number):
            work(batch, number)
            work(batch, number)

        return each(df, both, *more)

    monkeypatch.setattr(tables, "each_batch", twice)
    publish(spark, late_inbox, tmp_path)
    batch = gold.daily_metrics(gate.silver(gate.lenient_gate(small_bronze(spark))))
    assert rows(jobs.read_gold(spark, f"{tmp_path}/gold")) == rows(batch)
    once = keep_first(spark, late_inbox, tmp_path)
    assert once.count() == 960


def keep_first(spark, inbox, root, files=1):
    splitting.keep_first_deliveries(
        silver_stream(spark, inbox, files), f"{root}/once", f"{root}/once-cp", True
    ).awaitTermination()
    return tables.read_table(spark, f"{root}/once")


def test_no_event_is_lost_for_being_late(spark, late_inbox, tmp_path):
    once = keep_first(spark, late_inbox, tmp_path)
    assert once.count() == once.select("event_id").distinct().count() == 960


@pytest.mark.parametrize("files", [None, 2])
def test_repeats_are_dropped_whenever_they_come(spark, inbox, tmp_path, files):
    again = tables.read_table(spark, inbox).withColumn("partition", F.col("partition") + 4)
    again.withColumn("offset", F.col("offset") + 1_000_001).write.mode("append").parquet(inbox)
    once = keep_first(spark, inbox, tmp_path, files)
    assert once.count() == once.select("event_id").distinct().count() == 960


def test_an_event_sent_most_often_is_kept_once(spark, inbox, tmp_path):
    one = tables.read_table(spark, inbox).filter("offset = 1")
    offsets = F.sequence(F.lit(10_000).cast("long"), F.lit(11_999).cast("long"))
    flood = one.withColumn("offset", F.explode(offsets))
    flood.select(*one.columns).write.mode("append").parquet(inbox)
    once = keep_first(spark, inbox, tmp_path, 3)
    assert once.count() == 960
    assert once.filter("event_id = 'evt_1'").count() == 1


def test_a_new_checkpoint_on_old_sums_is_refused(spark, late_inbox, tmp_path):
    publish(spark, late_inbox, tmp_path)
    before = rows(jobs.read_gold(spark, f"{tmp_path}/gold"))
    again = daily.publish(
        silver_stream(spark, late_inbox), f"{tmp_path}/gold", f"{tmp_path}/other-cp", True
    )
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        again.awaitTermination()
    assert rows(jobs.read_gold(spark, f"{tmp_path}/gold")) == before


@pytest.mark.parametrize("files", [1, 50])
def test_repeats_written_for_another_day_are_dropped(spark, tmp_path, files):
    """48 events, each sent again for another day and zone: 48, however they fall into batches."""
    inbox = str(tmp_path / "inbox")
    sent = fixture.messages_from_events(fixture.event_table(spark, SF_DIR)).filter("offset < 50")
    text = F.col("value").cast("string")
    for copy, (date, zone) in enumerate((("2024-01", "Z"), ("2023-07", "+05:30"), ("2031-01", "Z"))):
        moved = F.regexp_replace(text, "2024-01(-[^Z]*)Z", f"{date}$1{zone}").cast("binary")
        again = sent.withColumns({"value": moved, "partition": F.col("partition") + 4 * copy})
        again.coalesce(1).write.mode("append").parquet(inbox)
    once = keep_first(spark, inbox, tmp_path, files)
    kept = gate.silver(gate.lenient_gate(small_bronze(spark).filter("offset < 50"))).count()
    assert once.count() == once.select("event_id").distinct().count() == kept == 48
    assert list(tmp_path.rglob("once-cp/state/0/*/*.zip"))  # RocksDB's files


def test_gold_out_of_what_a_stream_has_judged(spark, inbox, tmp_path):
    """Silver is read as it was judged, by whichever gate; Bronze is not judged again."""
    bronze = messages.envelope(messages.message_files(spark, inbox), fixture.landing_time())
    layers = str(tmp_path / "layers")
    splitting.split(bronze, layers, f"{tmp_path}/cp", "strict", True).awaitTermination()
    silver = splitting.silver_stream(spark, layers)
    daily.publish(silver, f"{tmp_path}/gold", f"{tmp_path}/gold-cp", True).awaitTermination()
    judged = jobs.read_layer(spark, layers, "silver")
    assert rows(jobs.read_gold(spark, f"{tmp_path}/gold")) == rows(gold.daily_metrics(judged))


@pytest.fixture()
def queries_in(spark, tmp_path, monkeypatch):
    """Stream queries with their folders in a known place, and messages that come in many files."""
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    events = tables.read_table(spark, f"{SF_DIR}/events.parquet")
    events.repartitionByRange(6, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield str(tmp_path)
    spark.conf.unset(setting)


def files_and_batches(folder):
    inbox, commits = Path(folder, "inbox"), Path(folder, "stream/checkpoint/commits")
    return len(list(inbox.glob("*.parquet"))), len([c for c in commits.iterdir() if c.name.isdigit()])


def test_sent_again_in_many_files_is_three_micro_batches(spark, queries_in):
    """No task writes or reads a whole copy; the first copy is still the one that is kept."""
    kept = catalog.stream_shifted_repeats(spark, queries_in)
    assert kept.count() == 960 and kept.agg(F.max("partition")).first()[0] == 3
    files, batches = files_and_batches(queries_in)
    assert files > 12 and batches == 3


@pytest.mark.parametrize(
    "query, most", [("stream_first_deliveries", 6), ("stream_gold_windowed", 3)]
)
def test_micro_batches_are_as_many_as_arrivals(spark, queries_in, query, most):
    assert catalog.QUERIES[query](spark, queries_in).count()
    files, batches = files_and_batches(queries_in)
    assert files > 12 and 1 < batches <= most


def test_events_of_one_row_group_are_dealt_out(spark, queries_in):
    """One file with one row group is the work of every task, not of one."""
    one = f"{queries_in}/one"
    fixture.event_table(spark, queries_in).coalesce(1).write.parquet(f"{one}/events.parquet")
    dealt = fixture.event_table(spark, one).groupBy(F.spark_partition_id()).count()
    assert dealt.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
