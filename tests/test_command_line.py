"""The command line from Bronze to the CSV, on one small table."""

from __future__ import annotations

import pytest

from helpers import small_bronze
from tallygate.__main__ import arguments, run
from tallygate.plans import jobs
from tallygate.sources import tables


@pytest.mark.parametrize("gate_name, kept", [("lenient", 960), ("strict", 900)])
def test_bronze_to_csv(spark, tmp_path, capsys, gate_name, kept):
    bronze, layers, gold_path = (str(tmp_path / name) for name in ("bronze", "layers", "gold"))
    tables.overwrite_table(small_bronze(spark), bronze, "ingest_date")

    def call(*argv):
        return run(spark, arguments([str(word) for word in argv]))

    for _ in range(2):
        call(
            *("split", "--bronze", bronze, "--layers", layers),
            *("--gate", gate_name),
        )
    assert call("metrics", "--layers", layers, "--gold", gold_path)
    stored = tables.read_table(spark, gold_path)
    assert stored.groupBy().sum("transaction_count").first()[0] == kept

    scan = ("scan", "--layers", layers, "--gold", gold_path, "--report", tmp_path / "report")
    for _ in range(2):
        assert not call(*scan, "--bronze", bronze)  # old events are not fresh
    report = tables.read_table(spark, str(tmp_path / "report")).collect()
    assert [r.metric for r in report if r.outcome == "FAIL"] == ["freshness"] * 2
    assert len({r.scanned_at for r in report}) == 2
    assert call("conserve", "--bronze", bronze, "--layers", layers, "--gold", gold_path)
    assert call("lag", "--layers", layers) and call("reasons", "--layers", layers)
    call("dedup", "--layers", layers, "--out", tmp_path / "once")
    assert tables.read_table(spark, str(tmp_path / "once")).count() == kept

    call("export", "--gold", gold_path, "--csv", tmp_path / "csv")
    exported = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert exported.count() == stored.count()

    capsys.readouterr()
    call("show-gold", "--gold", gold_path)
    assert "2024-01-01" in capsys.readouterr().out
    call("show-quarantine", "--layers", layers)
    assert "error_reason" in capsys.readouterr().out


def test_one_day_only(spark, tmp_path):
    bronze, layers = str(tmp_path / "bronze"), str(tmp_path / "layers")
    tables.overwrite_table(small_bronze(spark), bronze, "ingest_date")
    run(
        spark,
        arguments(
            ["split", "--bronze", bronze, "--layers", layers]
            + ["--first-day", "2024-01-05", "--last-day", "2024-01-05"]
        ),
    )
    days = tables.read_table(spark, layers).select("ingest_date").distinct().collect()
    assert [str(row.ingest_date) for row in days] == ["2024-01-05"]


def test_loading_what_is_new(spark, tmp_path):
    bronze, lake = str(tmp_path / "b"), str(tmp_path / "l")
    rows = small_bronze(spark)
    places = ["--bronze", bronze, "--lake", lake]
    for days in ("ingest_date <= '2024-01-10'", "ingest_date > '2024-01-10'", "false"):
        tables.append_table(rows.filter(days), bronze, "ingest_date")
        assert run(spark, arguments(["offsets", *places])) == (days == "false")
        run(spark, arguments(["load", *places]))
        assert run(spark, arguments(["offsets", *places]))
    run(spark, arguments(["load", *places, "--again", "2024-01-04", "2024-01-09"]))
    run(spark, arguments(["vacuum", "--lake", lake, "--older-than-hours", "0"]))
    stored = jobs.read_gold(spark, lake)
    assert stored.groupBy().sum("transaction_count").first()[0] == 960
    assert run(spark, arguments(["conserve", "--layers", lake, "--gold", lake]))
    run(spark, arguments(["scan", "--layers", lake, "--gold", lake]))
    run(spark, arguments(["export", "--gold", lake, "--csv", str(tmp_path / "csv")]))


def test_a_clean_load_needs_no_quarantine(spark, tmp_path, capsys):
    bronze, layers, gold_path = (str(tmp_path / name) for name in "blg")
    tables.overwrite_table(small_bronze(spark).filter("offset % 10 <> 0"), bronze, "ingest_date")
    for argv in (
        ["split", "--bronze", bronze, "--layers", layers],
        ["metrics", "--layers", layers, "--gold", gold_path, "--date-basis", "utc"],
    ):
        run(spark, arguments(argv))
    scan = ["scan", "--layers", layers, "--gold", gold_path]
    report = str(tmp_path / "report")
    run(spark, arguments([*scan, "--bronze", bronze, "--report", report]))
    asked = {(r.dataset, r.metric) for r in tables.read_table(spark, report).collect()}
    assert ("quarantine_fintech_transactions", "row_count") not in asked
    run(spark, arguments([*scan, "--report", report + "2"]))
    failed = tables.read_table(spark, report + "2").filter("outcome = 'FAIL'").collect()
    assert ("quarantine_fintech_transactions", "row_count") in {
        (r.dataset, r.metric) for r in failed
    }


def test_a_failed_report_ends_with_one(monkeypatch):
    from tallygate import __main__ as command

    class Session:
        def stop(self):
            pass

    monkeypatch.setattr(command, "build_session", lambda name: Session())
    monkeypatch.setattr(command.sys, "argv", ["tallygate", "show-gold", "--gold", "g"])
    for passed in (True, False):
        monkeypatch.setattr(command, "run", lambda spark, options: passed)
        if passed:
            command.main()
        else:
            with pytest.raises(SystemExit) as end:
                command.main()
            assert end.value.code == 1


def test_no_intake_cap_unless_asked_for():
    land = ["land", "--bootstrap-servers", "b", "--bronze", "x", "--checkpoint", "c"]
    assert arguments(land).max_offsets_per_trigger is None
    assert arguments([*land, "--max-offsets-per-trigger", "1000"]).max_offsets_per_trigger == 1000


def test_options_of_the_kafka_source():
    land = ["land", "--bootstrap-servers", "b", "--bronze", "x", "--checkpoint", "c"]
    secured = [*land, "--option", "kafka.security.protocol=SASL_SSL", "--option", "a=b=c"]
    assert dict(arguments(secured).option) == {"kafka.security.protocol": "SASL_SSL", "a": "b=c"}
    with pytest.raises(SystemExit):
        arguments([*land, "--option", "kafka.security.protocol"])


@pytest.mark.parametrize("gate_name", ["lenient", "strict", "strict-conditional"])
def test_every_gate_can_be_asked_for(spark, tmp_path, gate_name):
    bronze, lake = str(tmp_path / "b"), str(tmp_path / "l")
    tables.overwrite_table(small_bronze(spark, "contract"), bronze, "ingest_date")
    run(spark, arguments(["load", "--bronze", bronze, "--lake", lake, "--gate", gate_name]))
    reasons = jobs.read_layer(spark, lake, "quarantine").selectExpr("explode(reasons) AS reason")
    asked = not reasons.filter("reason LIKE 'COND:%'").isEmpty()
    assert asked == (gate_name == "strict-conditional")


@pytest.mark.parametrize(
    "argv",
    [
        ["follow-gold", "--gold", "g", "--checkpoint", "c"],
        ["follow-gold", "--gold", "g", "--checkpoint", "c", "--bronze", "b", "--layers", "l"],
        ["metrics", "--gold", "g"],
        ["split", "--bronze", "b"],
        ["load", "--bronze", "b"],
        ["follow-once", "--bronze", "b", "--out", "o"],
    ],
)
def test_missing_places_are_refused(argv):
    with pytest.raises(SystemExit):
        arguments(argv)
