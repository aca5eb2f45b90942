"""Jobs end to end: reruns, replays, conservation, checks, exports."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import SF_DIR, rows, small_bronze
from tallygate.functions import casts
from tallygate.operators import checks, gate, gold, reliability
from tallygate.plans import catalog, jobs, lake
from tallygate.session import shared_folder
from tallygate.simulation import fixture, lifecycle
from tallygate.sources import messages, tables


def text_frame(spark, values, name="text"):
    return spark.createDataFrame([(value,) for value in values], f"{name} string")


def test_rerunning_days_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "layers")
    bronze = small_bronze(spark)
    for _ in range(2):
        jobs.split_days(bronze, path, as_of=F.timestamp_micros(F.lit(0)))
    one_day = bronze.filter(F.col("ingest_date") == datetime.date(2024, 1, 5))
    jobs.split_days(one_day, path, as_of=F.timestamp_micros(F.lit(0)))
    silver = jobs.read_layer(spark, path, "silver")
    quarantine = jobs.read_layer(spark, path, "quarantine")
    assert silver.count() + quarantine.count() == bronze.count() == 1000
    assert silver.select(*gate.POSITION).distinct().count() == silver.count() == 960
    assert silver.columns == list(gate.SILVER_COLUMNS)


def sides(spark, path):
    return [jobs.read_layer(spark, path, layer) for layer in ("silver", "quarantine")]


def test_a_replay_by_another_gate_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "layers")
    bronze = small_bronze(spark)
    for gate_name, kept in (("strict", 900), ("lenient", 960), ("strict", 900)):
        jobs.split_days(bronze, path, gate_name)
        silver, quarantine = sides(spark, path)
        assert (silver.count(), quarantine.count()) == (kept, 1000 - kept)
        report = reliability.conservation(bronze, silver, quarantine, gold.daily_metrics(silver))
        assert report.first().outcome == "PASS"


def test_conservation_sees_rows_lost_and_rows_twice(spark):
    bronze = small_bronze(spark)
    gated = gate.lenient_gate(bronze)
    silver, quarantine = gate.silver(gated), gate.quarantine(gated)
    metrics = gold.daily_metrics(silver)
    for wrong in (silver.filter("offset <> 1"), silver.unionByName(silver)):
        assert reliability.conservation(bronze, wrong, quarantine, metrics).first().outcome == "FAIL"


def test_both_sides_of_a_day_are_in_the_same_files(spark, tmp_path):
    path = tmp_path / "layers"
    jobs.split_days(small_bronze(spark).coalesce(1), str(path))
    assert {p.name for p in path.iterdir() if p.is_dir()} == {
        f"ingest_date=2024-01-{day:02d}" for day in range(1, 31)
    }
    assert all(len(list(day.glob("*.parquet"))) == 1 for day in path.glob("ingest_date=*"))


def test_batch_writes_to_a_streamed_path_are_refused(spark, tmp_path):
    path = tmp_path / "layers"
    (path / "_spark_metadata").mkdir(parents=True)
    bronze = small_bronze(spark)
    for write in (
        lambda: jobs.split_days(bronze, str(path)),
        lambda: tables.append_table(bronze, str(path)),
        lambda: tables.overwrite_table(bronze, str(path)),
    ):
        with pytest.raises(ValueError, match="stream"):
            write()


def test_loading_new_days(spark, tmp_path):
    bronze_path, path = str(tmp_path / "bronze"), str(tmp_path / "layers")
    bronze = small_bronze(spark)
    tables.append_table(bronze.filter("ingest_date <= '2024-01-10'"), bronze_path, "ingest_date")
    assert len(jobs.load_new_days(spark, bronze_path, path)) == 10
    assert jobs.load_new_days(spark, bronze_path, path) == []
    later = bronze.filter("ingest_date > '2024-01-10'")
    tables.append_table(later, bronze_path, "ingest_date")
    # More messages for a day that was loaded already.
    more = bronze.filter("ingest_date = '2024-01-04'").withColumn("partition", F.lit(9))
    tables.append_table(more, bronze_path, "ingest_date")
    days = jobs.load_new_days(spark, bronze_path, path)
    assert datetime.date(2024, 1, 4) in days and datetime.date(2024, 1, 5) not in days
    assert len(days) == 21
    assert sum(s.count() for s in sides(spark, path)) == 1000 + more.count()
    assert jobs.load_new_days(spark, bronze_path, path) == []


def test_gold_kept_up_to_date_equals_gold_built_anew(spark, tmp_path):
    bronze_path, root = str(tmp_path / "bronze"), str(tmp_path / "lake")
    bronze = small_bronze(spark)
    tables.overwrite_table(bronze, bronze_path, "ingest_date")

    def check():
        silver = jobs.read_layer(spark, root, "silver")
        assert rows(jobs.read_gold(spark, root)) == rows(gold.daily_metrics(silver))

    lake.load(spark, bronze_path, root)
    check()
    one = datetime.date(2024, 1, 4)
    # Other verdicts on a day, then no message at all that passes.
    lake.load(spark, bronze_path, root, "strict", again=[one])
    check()
    bad = bronze.filter(F.col("ingest_date") == one).withColumn("raw_value", F.lit("{"))
    tables.overwrite_partitions(bad, bronze_path, "ingest_date")
    lake.load(spark, bronze_path, root, again=[one])
    check()
    assert lake.load(spark, bronze_path, root) == []
    # The two ways to make Gold do not share a place.
    with pytest.raises(ValueError, match="another place"):
        jobs.build_gold(jobs.read_layer(spark, root, "silver"), root)


def test_first_delivery_with_one_event_sent_most_often(spark):
    events = spark.range(3000).select(
        F.lit("t").alias("topic"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), "id")).alias("event_id"),
    )
    kept = reliability.first_deliveries(events.repartition(7))
    assert kept.count() == 2001
    assert kept.filter("event_id = 'hot'").first().offset == 0


def test_layers_do_not_depend_on_row_order(spark):
    forward = small_bronze(spark).orderBy("offset")
    backward = small_bronze(spark).orderBy(F.desc("offset")).repartition(3)
    metrics = [gold.daily_metrics(gate.silver(gate.strict_gate(b))) for b in (forward, backward)]
    assert rows(metrics[0]) == rows(metrics[1])


def test_metrics_on_odd_amounts_and_null_groups(spark):
    silver = spark.createDataFrame(
        [
            ("2024-03-01T23:00:00-05:00", "USD", "settled", "0.10", 80),
            ("2024-03-01T01:00:00Z", "USD", "settled", "0.20", 79),
            ("2024-03-01", "USD", "settled", "NaN", None),
            ("junk", "USD", "settled", "5d", 100),
            ("2024-13-01", None, "settled", None, None),
        ],
        "event_time string, currency string, status string, amount string, risk_score int",
    )
    exact = {
        (r.event_date, r.currency): r
        for r in gold.daily_metrics(silver).collect()
    }
    day = datetime.date(2024, 3, 1)
    assert exact[day, "USD"].transaction_count == 3
    assert str(exact[day, "USD"].total_amount) == "0.30"
    assert exact[day, "USD"].avg_amount == 0.15
    assert exact[day, "USD"].high_risk_txn_count == 1
    assert exact[None, "USD"].total_amount is None
    assert exact[None, "USD"].avg_amount is None
    assert exact[None, None].transaction_count == 1

    doubles = {
        (r.event_date, r.currency): r
        for r in gold.daily_metrics(silver, amounts="double").collect()
    }
    assert doubles[day, "USD"].total_amount != doubles[day, "USD"].total_amount  # NaN
    assert doubles[None, "USD"].total_amount == 5.0

    utc = gold.daily_metrics(silver, date_basis="utc").collect()
    assert datetime.date(2024, 3, 2) in {r.event_date for r in utc}


def test_casts(spark):
    frame = text_frame(spark, ["2024-03-01T23:00:00-05:00", "2024-3-1Tjunk", "2024-13-01", ""])
    dates = [r[0] for r in frame.select(casts.written_date(F.col("text"))).collect()]
    assert dates == [datetime.date(2024, 3, 1), datetime.date(2024, 3, 1), None, None]
    money = text_frame(spark, ["12345678901234567890.12", "1.005", "abc", "1e3"])
    values = [r[0] for r in money.select(casts.money(F.col("text"))).collect()]
    assert [str(v) for v in values] == ["12345678901234567890.12", "1.01", "None", "1000.00"]
    odd = text_frame(spark, ["2024-03-01t10:00:00z", "2024-02-30t10:00:00z", "2024-03-01t10"])
    dates = [r[0] for r in odd.select(casts.written_date(F.col("text"))).collect()]
    assert dates == [datetime.date(2024, 3, 1), None, None]


def test_lifecycle(spark):
    frame = text_frame(spark, [*lifecycle.LIFECYCLE_STATUS, "unknown"])
    found = frame.select(
        "text",
        lifecycle.lifecycle_status(F.col("text")).alias("status"),
        lifecycle.is_failure(F.col("text")).alias("failed"),
    ).collect()
    assert {r.text: r.status for r in found} == {**lifecycle.LIFECYCLE_STATUS, "unknown": None}
    assert [r.text for r in found if r.failed] == ["transaction_failed"]


def test_checks_pass_and_fail(spark):
    frame = spark.createDataFrame(
        [(1.0, "a"), (None, "b"), (-2.0, None)], "amount double, code string"
    )
    report = checks.scan(
        "d",
        frame,
        (
            checks.Check(checks.ROW_COUNT, ">", 0),
            checks.Check(checks.ROW_COUNT, "<=", 2),
            checks.Check(checks.MISSING_COUNT, "=", 0, "code"),
            checks.Check(checks.INVALID_COUNT, "=", 0, "amount", valid_max=10),
            checks.Check(checks.INVALID_COUNT, "=", 0, "amount", valid_min=0),
        ),
    ).collect()
    assert [(r.value, r.outcome) for r in report] == [
        (3, "PASS"),
        (3, "FAIL"),
        (1, "FAIL"),
        (0, "PASS"),
        (1, "FAIL"),
    ]
    assert report[4].check_id == "invalid_count(amount) = 0"
    assert tuple(report[0].asDict()) == checks.REPORT_COLUMNS


@pytest.mark.parametrize(
    "stamps, outcome",
    [(["2024-01-01 00:30:00"], "PASS"), (["2024-01-01 00:00:00"], "FAIL"), ([], "FAIL")],
)
def test_freshness(spark, stamps, outcome):
    frame = text_frame(spark, stamps).select(F.to_timestamp("text").alias("event_time_ts"))
    as_of = F.to_timestamp(F.lit("2024-01-01 01:00:00"))
    report = checks.scan("d", frame, checks.FRESHNESS_CHECKS, as_of).first()
    assert report.outcome == outcome


def test_not_a_number_is_invalid(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,)], "amount double")
    check = checks.Check(checks.INVALID_COUNT, "=", 0, "amount", valid_min=0)
    assert checks.scan("d", frame, (check,)).first().value == 2


def test_empty_quarantine(spark, tmp_path):
    """Nothing bad: both layers stay readable, and the conditional check is left out."""
    path = str(tmp_path / "layers")
    bronze = small_bronze(spark).filter("offset % 10 <> 0")
    jobs.split_days(bronze, path)
    silver, quarantine = sides(spark, path)
    assert not jobs.quarantine_is_due(bronze, silver)
    assert jobs.quarantine_is_due(small_bronze(spark), silver)
    strict = checks.scan("q", quarantine, checks.quarantine_checks(expect_bad_rows=True))
    relaxed = checks.scan("q", quarantine, checks.quarantine_checks(expect_bad_rows=False))
    assert {r.outcome for r in strict.collect()} == {"PASS", "FAIL"}
    assert {r.outcome for r in relaxed.collect()} == {"PASS"}


def test_scan_of_all_layers(spark):
    gated = gate.lenient_gate(small_bronze(spark))
    silver, quarantine = gate.silver(gated), gate.quarantine(gated)
    report = jobs.scan_layers(silver, quarantine, gold.daily_metrics(silver)).collect()
    failed = [r.check_id for r in report if r.outcome == "FAIL"]
    assert failed == ["freshness(event_time_ts) < 3600"]
    assert len(report) == 6 + 1 + 3 + 8


def test_fixture_proportions(spark):
    """Shares of intact and damaged messages, and what each gate lets through."""
    bronze = small_bronze(spark)
    assert gate.silver(gate.lenient_gate(bronze)).count() == 960
    strict = gate.quarantine(gate.strict_gate(bronze))
    assert strict.count() == 100
    families = {
        r.reason.split(":")[0]
        for r in gate.reason_counts(
            gate.quarantine(gate.strict_gate(small_bronze(spark, "contract"), conditional=True))
        ).collect()
    }
    assert families == {
        "MALFORMED_JSON",
        "ROOT_TYPE",
        "MISSING",
        "TYPE",
        "PATTERN",
        "ENUM",
        "FORMAT",
        "RANGE",
        "EXTRA",
        "COND",
    }


def test_bronze_columns(spark):
    assert small_bronze(spark).columns == list(messages.BRONZE_COLUMNS)
    stamped = messages.envelope(fixture.messages_from_events(fixture.event_table(spark, SF_DIR)))
    assert stamped.select("ingested_at").distinct().count() == 1


class RecordingReader:
    """Stands in for the stream reader: what it was told, and no broker."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **more):
        self.told |= more
        return self

    def load(self):
        return self.told


def test_kafka_options():
    session = type("Session", (), {"readStream": property(lambda self: RecordingReader())})()
    assert messages.kafka_messages(session, "b:9092") == {
        "format": "kafka",
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "fintech_transactions",
        "startingOffsets": "earliest",
    }
    told = messages.kafka_messages(
        session, "b", "t", "latest", messages.DEMO_OFFSETS_PER_TRIGGER, {"failOnDataLoss": "false"}
    )
    assert (told["subscribe"], told["startingOffsets"]) == ("t", "latest")
    assert (told["maxOffsetsPerTrigger"], told["failOnDataLoss"]) == (1000, "false")


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_messages(spark, "broker:9092")


def test_shared_folder_is_under_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (shared_folder(spark, "x") for _ in range(2))
    assert first.startswith(f"{base}/x-")
    assert first != second
    assert not tables.exists(spark, first)


def test_intermediate_folders_go_away_with_the_session(tmp_path):
    import subprocess
    import sys
    import time

    program = f"""
from pyspark.sql import SparkSession
from tallygate.session import shared_folder
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
path = shared_folder(spark, "left")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
"""
    subprocess.run([sys.executable, "-c", program], check=True, timeout=120)
    for _ in range(60):  # the JVM ends a little after Python
        if not list(tmp_path.glob("left-*")):
            break
        time.sleep(0.5)
    assert not list(tmp_path.glob("left-*"))


def test_without_a_shared_folder_there_is_an_error():
    context = type("C", (), {})()
    context._jsc = type("J", (), {"sc": lambda self: self, "getCheckpointDir": lambda self: self,
                                  "isDefined": lambda self: False})()
    conf = type("F", (), {"get": lambda self, key, default: default})()
    session = type("S", (), {"conf": conf, "sparkContext": context})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session, "x")


def test_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.export_csv(catalog.gold_daily_metrics(spark, SF_DIR), path)
    first_lines = {
        part.read_text().splitlines()[0] for part in (tmp_path / "csv").glob("part-*.csv")
    }
    assert first_lines == {
        "event_date,currency,status,transaction_count,total_amount,avg_amount,high_risk_txn_count"
    }
