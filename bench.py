"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the test tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local cores                 (default 8)

Three groups: ``gate_*`` runs the gates over 1,000,000 stored Bronze rows at sf0.1 (ten
copies of the fixture, by landing day), ``split_*`` also writes both layers, the rest are
registered queries as they are. Each is run twice after the session is warm; the faster
run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tallygate.operators import gate, gold
from tallygate.plans import jobs
from tallygate.plans.catalog import QUERIES
from tallygate.session import SETTINGS, shared_folder
from tallygate.simulation import fixture
from tallygate.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = 10
RUNS = 2
HEADLINE = (
    "gold_daily_metrics",
    "gold_strict_metrics",
    "gold_preview",
    "silver_lenient",
    "silver_strict",
    "quarantine_strict",
    "quarantine_reason_counts",
    "silver_typed",
    "silver_dedup",
    "silver_incremental",
    "layer_conservation",
    "layer_lag",
    "dq_scan_silver",
    "dq_scan_gold",
    "stream_bronze_append",
    "stream_silver_split",
    "stream_gold_windowed",
)


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallygate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallygate-bench-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    bronze_path = shared_folder(spark, "bronze")
    once = fixture.bronze_from_events(fixture.event_table(spark, SF_DIR))
    copies = reduce(DataFrame.unionAll, [once] * COPIES)
    # As landing leaves it: a folder for each day.
    tables.overwrite_table(copies.repartition("ingest_date"), bronze_path, "ingest_date")
    bronze = tables.read_table(spark, bronze_path)
    layers_path = shared_folder(spark, "layers")
    jobs.split_days(bronze, layers_path)
    silver = jobs.read_layer(spark, layers_path, "silver")

    work = {
        "gate_lenient": lambda: drain(gate.lenient_gate(bronze)),
        "gate_strict": lambda: drain(gate.strict_gate(bronze)),
        "split_lenient": lambda: jobs.split_days(bronze, shared_folder(spark, "split")),
        "split_strict": lambda: jobs.split_days(bronze, shared_folder(spark, "split"), "strict"),
        "gold_from_silver": lambda: drain(gold.daily_metrics(silver)),
    }
    for name in HEADLINE:
        work[name] = lambda query=QUERIES[name]: drain(query(spark, SF_DIR))

    seconds = {}
    for name, run in work.items():
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            run()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
