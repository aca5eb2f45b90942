"""The jobs from the command line: ``spark-submit run_job.py <job> ...``.

Paths may be on any file system the cluster is set up for.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.operators import gate, gold, reliability
from tallygate.plans import jobs, lake
from tallygate.session import build_session
from tallygate.sources import messages, snapshots, tables
from tallygate.streaming import daily, landing, splitting


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallygate", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    land = commands.add_parser("land", help="Kafka topic to Bronze, until stopped")
    land.add_argument("--bootstrap-servers", required=True)
    land.add_argument("--topic", default=messages.TOPIC)
    land.add_argument("--starting-offsets", default=messages.STARTING_OFFSETS)
    land.add_argument(
        "--max-offsets-per-trigger", type=int, help="intake cap of one micro-batch, if any"
    )
    land.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE",
        help="any option of the Kafka source, e.g. kafka.security.protocol=SASL_SSL; repeatable",
    )
    land.add_argument("--bronze", required=True)
    land.add_argument("--checkpoint", required=True)

    split = commands.add_parser("split", help="Bronze to Silver and Quarantine, whole days anew")
    split.add_argument("--bronze", required=True)
    split.add_argument("--layers", required=True)
    split.add_argument("--gate", choices=tuple(gate.GATES), default="lenient")
    split.add_argument("--first-day", type=datetime.date.fromisoformat)
    split.add_argument("--last-day", type=datetime.date.fromisoformat)

    load = commands.add_parser(
        "load", help="bring Silver, Quarantine and Gold up to date with Bronze, all or nothing"
    )
    load.add_argument("--bronze", required=True)
    load.add_argument("--lake", required=True, help="give it as --layers and --gold elsewhere")
    load.add_argument("--gate", choices=tuple(gate.GATES), default="lenient")
    load.add_argument(
        "--again", type=datetime.date.fromisoformat, nargs="*", default=[],
        help="landing days to judge anew",
    )
    load.add_argument(
        "--rebalance", action="store_true",
        help="for Bronze whose files mix many days: few files a day, for a shuffle",
    )
    load.add_argument("--date-basis", choices=("written", "utc"), default="written")

    follow = commands.add_parser("follow", help="split as a stream, until stopped")
    follow.add_argument("--bronze", required=True)
    follow.add_argument("--layers", required=True)
    follow.add_argument("--checkpoint", required=True)
    follow.add_argument("--gate", choices=tuple(gate.GATES), default="lenient")

    follow_gold = commands.add_parser(
        "follow-gold", help="Gold as a stream, out of what follow writes or out of Bronze"
    )
    follow_gold.add_argument("--bronze")
    follow_gold.add_argument("--layers", help="Silver as follow judges it; nothing is judged again")
    follow_gold.add_argument("--gold", required=True)
    follow_gold.add_argument("--checkpoint", required=True)
    follow_gold.add_argument("--gate", choices=tuple(gate.GATES), default="lenient")
    follow_gold.add_argument("--date-basis", choices=("written", "utc"), default="written")

    follow_once = commands.add_parser(
        "follow-once", help="Silver as a stream with one message for each event"
    )
    follow_once.add_argument("--bronze", required=True)
    follow_once.add_argument("--out", required=True)
    follow_once.add_argument("--checkpoint", required=True)
    follow_once.add_argument("--gate", choices=tuple(gate.GATES), default="lenient")

    missing = commands.add_parser(
        "offsets", help="ranges of offsets a lake lacks or has too often; ends with 1 if any"
    )
    missing.add_argument("--bronze", required=True)
    missing.add_argument("--lake", required=True)

    vacuum = commands.add_parser("vacuum", help="delete folders of a lake that nothing names")
    vacuum.add_argument("--lake", required=True)
    vacuum.add_argument("--keep", type=int, default=10, help="snapshots to keep")
    vacuum.add_argument("--older-than-hours", type=float, default=72)

    metrics = commands.add_parser("metrics", help="Silver to Gold, all of it anew")
    metrics.add_argument("--layers", required=True)
    metrics.add_argument("--gold", required=True)
    metrics.add_argument("--amounts", choices=("decimal", "double"), default="decimal")
    metrics.add_argument("--date-basis", choices=("written", "utc"), default="written")

    dedup = commands.add_parser("dedup", help="Silver with one message for each event")
    dedup.add_argument("--layers", required=True)
    dedup.add_argument("--out", required=True)

    export = commands.add_parser("export", help="Gold to CSV")
    export.add_argument("--gold", required=True)
    export.add_argument("--csv", required=True)

    scan = commands.add_parser("scan", help="check report over all layers; ends with 1 on a FAIL")
    scan.add_argument("--layers", required=True)
    scan.add_argument("--gold", required=True)
    scan.add_argument("--bronze", help="to tell whether Quarantine must have rows")
    scan.add_argument("--report", help="Parquet table to which the report is added")

    for name, text in (
        ("conserve", "whether no row was lost between the layers; ends with 1 on a FAIL"),
        ("lag", "seconds from layer to layer"),
        ("reasons", "how many messages failed for each reason"),
    ):
        command = commands.add_parser(name, help=text)
        command.add_argument("--layers", required=True)
        if name == "conserve":
            command.add_argument("--bronze", help="needed where the layers are no lake")
            command.add_argument("--gold", required=True)

    show_gold = commands.add_parser("show-gold", help="first rows of Gold")
    show_gold.add_argument("--gold", required=True)
    show_quarantine = commands.add_parser("show-quarantine", help="first quarantined messages")
    show_quarantine.add_argument("--layers", required=True)

    options = parser.parse_args(argv)
    if options.job == "land":
        pairs = [given.partition("=") for given in options.option]
        if not all(name and equals for name, equals, _ in pairs):
            parser.error("--option takes NAME=VALUE")
        options.option = [(name, value) for name, _, value in pairs]
    if options.job == "follow-gold" and bool(options.bronze) == bool(options.layers):
        parser.error("give either --bronze, to be judged, or --layers, as follow writes them")
    return options


def _show(df: DataFrame, width: int | bool) -> None:
    df.show(gold.PREVIEW_ROWS, truncate=width)


def run(spark: SparkSession, options: argparse.Namespace) -> bool:
    """Do the job; False if it is a report that something FAILs in."""

    def layer(name: str) -> DataFrame:
        return jobs.read_layer(spark, options.layers, name)

    if options.job == "land":
        stream = messages.kafka_messages(
            spark,
            options.bootstrap_servers,
            options.topic,
            options.starting_offsets,
            options.max_offsets_per_trigger,
            dict(options.option),
        )
        landing.land(stream, options.bronze, options.checkpoint).awaitTermination()
    elif options.job == "split":
        bronze = tables.bronze_days(spark, options.bronze, options.first_day, options.last_day)
        jobs.split_days(bronze, options.layers, options.gate)
    elif options.job == "load":
        lake.load(
            spark,
            options.bronze,
            options.lake,
            options.gate,
            date_basis=options.date_basis,
            again=options.again,
            rebalance=options.rebalance,
        )
    elif options.job == "offsets":
        bronze = tables.read_table(spark, options.bronze)
        found = lake.offset_differences(spark, bronze, options.lake).persist()
        _show(found, False)
        return found.isEmpty()
    elif options.job == "vacuum":
        snapshots.vacuum(spark, options.lake, options.keep, options.older_than_hours)
    elif options.job == "follow-once":
        gated = gate.GATES[options.gate](splitting.bronze_stream(spark, options.bronze))
        splitting.keep_first_deliveries(
            gate.silver(gated), options.out, options.checkpoint
        ).awaitTermination()
    elif options.job == "follow":
        bronze = splitting.bronze_stream(spark, options.bronze)
        splitting.split(
            bronze, options.layers, options.checkpoint, options.gate
        ).awaitTermination()
    elif options.job == "follow-gold":
        if options.layers:
            passed = splitting.silver_stream(spark, options.layers)
        else:
            bronze = splitting.bronze_stream(spark, options.bronze)
            passed = gate.silver(gate.GATES[options.gate](bronze))
        daily.publish(
            passed,
            options.gold,
            options.checkpoint,
            date_basis=options.date_basis,
        ).awaitTermination()
    elif options.job == "metrics":
        jobs.build_gold(layer("silver"), options.gold, options.amounts, options.date_basis)
    elif options.job == "dedup":
        tables.overwrite_table(reliability.first_deliveries(layer("silver")), options.out)
    elif options.job == "export":
        tables.export_csv(jobs.read_gold(spark, options.gold), options.csv)
    elif options.job == "scan" and lake.is_lake(spark, options.layers):
        now = F.current_timestamp()
        report = lake.scan(spark, options.layers, now).withColumn("scanned_at", now)
        return _reported(report, options.report)
    elif options.job == "scan":
        due = not options.bronze or jobs.quarantine_is_due(
            tables.read_table(spark, options.bronze), layer("silver")
        )
        report = jobs.scan_layers(
            layer("silver"),
            layer("quarantine"),
            jobs.read_gold(spark, options.gold),
            F.current_timestamp(),
            due,
        ).withColumn("scanned_at", F.current_timestamp())
        return _reported(report, options.report)
    elif options.job == "conserve" and lake.is_lake(spark, options.layers):
        return _reported(lake.conservation(spark, options.layers))
    elif options.job == "conserve":
        return _reported(
            reliability.conservation(
                tables.read_table(spark, options.bronze),
                layer("silver"),
                layer("quarantine"),
                jobs.read_gold(spark, options.gold),
            )
        )
    elif options.job == "lag":
        _show(reliability.layer_lag(gate.typed(layer("silver"))), False)
    elif options.job == "reasons":
        _show(gate.reason_counts(layer("quarantine")), False)
    elif options.job == "show-gold":
        _show(gold.gold_preview(jobs.read_gold(spark, options.gold)), False)
    elif options.job == "show-quarantine":
        _show(gold.quarantine_preview(layer("quarantine")), 120)
    return True


def _reported(report: DataFrame, path: str | None = None) -> bool:
    report = report.persist()  # a few rows, looked at three times
    try:
        if path:
            tables.append_table(report, path)
        _show(report, False)
        return report.filter("outcome = 'FAIL'").isEmpty()
    finally:
        report.unpersist()


def main() -> None:
    options = arguments()
    spark = build_session(f"tallygate-{options.job}")
    passed = run(spark, options)
    spark.stop()
    if not passed:
        sys.exit(1)


if __name__ == "__main__":
    main()
