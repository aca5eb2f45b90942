"""The gate on hand-made payloads: what each gate makes of every odd message."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallygate.functions.event_model import CONTRACT, LENIENT_REASON
from tallygate.operators import gate, gold

GOOD = {
    "event_id": "evt_1",
    "transaction_id": "txn_1",
    "user_id": "usr_1",
    "merchant_id": "mrc_1",
    "amount": "12.50",
    "currency": "USD",
    "payment_method": "card",
    "transaction_type": "purchase",
    "status": "settled",
    "failure_reason": None,
    "event_time": "2024-03-01T10:00:00Z",
    "ingested_at": "2024-03-01T10:00:01.5+05:30",
    "risk_score": 40,
    "source_system": "sim",
    "schema_version": 1,
}
TEXT = json.dumps(GOOD)


def changed(**fields):
    return json.dumps({**GOOD, **fields})


def without(*names):
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def with_number(name, literal):
    """The good event with a bare JSON literal, spelled exactly so, for one field."""
    return TEXT.replace(f'"{name}": {json.dumps(GOOD[name])}', f'"{name}": {literal}')


def bronze(spark, texts):
    rows = [("t", 0, offset, text) for offset, text in enumerate(texts)]
    messages = spark.createDataFrame(
        rows, "topic string, partition int, offset long, raw_value string"
    )
    moment = F.timestamp_micros(F.lit(1709287200000000))
    return messages.select(
        "topic",
        "partition",
        "offset",
        moment.alias("kafka_timestamp"),
        F.lit("k").alias("kafka_key"),
        "raw_value",
        moment.alias("ingested_at"),
    )


# text, passes the lenient gate, reasons of the strict gate
CASES = {
    "valid": (TEXT, True, []),
    "key order does not matter": (json.dumps(dict(reversed(GOOD.items()))), True, []),
    "surrounding space": (f"  {TEXT}\n", True, []),
    "a bracket inside a text": (changed(user_id="usr]["), True, []),
    "optional fields absent": (without("failure_reason", "risk_score"), True, []),
    "risk null": (changed(risk_score=None), True, []),
    "empty text counts as a value": (changed(user_id=""), True, []),
    "required key absent": (without("amount"), False, ["MISSING:amount"]),
    "contract-only key absent": (without("ingested_at"), True, ["MISSING:ingested_at"]),
    "required null": (changed(currency=None), False, ["TYPE:currency"]),
    "amount a number": (with_number("amount", "12.50"), True, ["TYPE:amount"]),
    "amount an object": (changed(amount={"v": 1}), True, ["TYPE:amount"]),
    "status a boolean": (changed(status=True), True, ["TYPE:status"]),
    "reason a number": (changed(failure_reason=5), True, ["TYPE:failure_reason"]),
    "risk as text": (changed(risk_score="80"), True, ["TYPE:risk_score"]),
    "risk with a fraction": (with_number("risk_score", "80.5"), True, ["TYPE:risk_score"]),
    "risk 80.0 is whole": (with_number("risk_score", "80.0"), True, []),
    "risk 1e2 is whole": (with_number("risk_score", "1e2"), True, []),
    "risk 1.5e0 is not": (with_number("risk_score", "1.5e0"), True, ["TYPE:risk_score"]),
    "risk of 20 digits": (
        with_number("risk_score", "12345678901234567890"),
        True,
        ["RANGE:risk_score"],
    ),
    "risk beyond 32 bits": (with_number("risk_score", "3000000000"), True, ["RANGE:risk_score"]),
    "version beyond 32 bits": (with_number("schema_version", "3000000000"), True, []),
    "risk 100": (changed(risk_score=100), True, []),
    "risk 101": (changed(risk_score=101), True, ["RANGE:risk_score"]),
    "risk -1": (changed(risk_score=-1), True, ["RANGE:risk_score"]),
    "version 0": (changed(schema_version=0), True, ["RANGE:schema_version"]),
    "version null": (changed(schema_version=None), True, ["TYPE:schema_version"]),
    "amount without cents": (changed(amount="7"), True, []),
    "amount negative": (changed(amount="-5.00"), True, ["PATTERN:amount"]),
    "amount NaN": (changed(amount="NaN"), True, ["PATTERN:amount"]),
    "amount with exponent": (changed(amount="1e3"), True, ["PATTERN:amount"]),
    "amount with one decimal": (changed(amount="12.5"), True, ["PATTERN:amount"]),
    "amount then newline": (changed(amount="12.50\n"), True, ["PATTERN:amount"]),
    "currency lower case": (changed(currency="usd"), True, ["PATTERN:currency"]),
    "currency too long": (changed(currency="USDX"), True, ["PATTERN:currency"]),
    "payment method unknown": (changed(payment_method="cash"), True, ["ENUM:payment_method"]),
    "transaction type unknown": (changed(transaction_type="x"), True, ["ENUM:transaction_type"]),
    "status misspelt": (changed(status="authorised"), True, ["ENUM:status"]),
    "time with offset": (changed(event_time="2024-03-01T23:00:00-05:00"), True, []),
    "time lower case": (changed(event_time="2024-03-01t23:00:00z"), True, []),
    "time leap second": (changed(event_time="2016-12-31T23:59:60Z"), True, []),
    "time leap day": (changed(event_time="2024-02-29T00:00:00Z"), True, []),
    "time no leap day": (
        changed(event_time="2023-02-29T00:00:00Z"),
        True,
        ["FORMAT:event_time"],
    ),
    "time month 13": (changed(event_time="2024-13-01T00:00:00Z"), True, ["FORMAT:event_time"]),
    "time without zone": (changed(event_time="2024-03-01T00:00:00"), True, ["FORMAT:event_time"]),
    "time with a space": (
        changed(ingested_at="2024-03-01 00:00:00Z"),
        True,
        ["FORMAT:ingested_at"],
    ),
    "time loose": (changed(event_time="2024-3-1Tjunk"), True, ["FORMAT:event_time"]),
    "unknown key": (changed(zeta=1), True, ["EXTRA:zeta"]),
    "unknown keys sorted": (changed(zeta=1, alpha=[1, "a"]), True, ["EXTRA:alpha", "EXTRA:zeta"]),
    "unknown key like a schema": (changed(**{"a: BIGINT, b": 1}), True, ["EXTRA:a: BIGINT, b"]),
    "several": (
        json.dumps({**GOOD, "status": "x", "risk_score": 101, "q": 1}).replace(
            '"amount": "12.50", ', ""
        ),
        False,
        ["MISSING:amount", "ENUM:status", "RANGE:risk_score", "EXTRA:q"],
    ),
    "truncated": (TEXT[:-1], False, ["MALFORMED_JSON"]),
    "trailing text": (f"{TEXT} junk", True, ["MALFORMED_JSON"]),
    "trailing comma": (f"{TEXT},", True, ["MALFORMED_JSON"]),
    "two objects": (f"{TEXT} {TEXT}", True, ["MALFORMED_JSON"]),
    "two objects and a comma": (f"{TEXT},{TEXT}", True, ["MALFORMED_JSON"]),
    "closes the array wrap early": (f"{TEXT}]x", True, ["MALFORMED_JSON"]),
    "closes the object wrap early": (f"{TEXT}}}x", True, ["MALFORMED_JSON"]),
    "starts by closing the wrap": (f"1],[{TEXT}", False, ["MALFORMED_JSON"]),
    "duplicate key": (TEXT[:-1] + ', "amount": "9.00"}', True, ["MALFORMED_JSON"]),
    "single quotes": (TEXT.replace('"', "'"), True, ["MALFORMED_JSON"]),
    "not a number": (with_number("risk_score", "NaN"), True, ["MALFORMED_JSON"]),
    "leading zeros": (with_number("risk_score", "007"), False, ["MALFORMED_JSON"]),
    "control character": (TEXT.replace("usr_1", "usr\x01"), False, ["MALFORMED_JSON"]),
    "escaped control character": (changed(user_id="usr\x01"), True, []),
    "escaped key": (TEXT.replace('"amount"', '"\\u0061mount"'), True, []),
    "empty text": ("", False, ["MALFORMED_JSON"]),
    "only spaces": ("  ", False, ["MALFORMED_JSON"]),
    "tombstone": (None, False, ["MALFORMED_JSON"]),
    "root array": (f"[{TEXT}]", False, ["ROOT_TYPE"]),
    "root null": ("null", False, ["ROOT_TYPE"]),
    "root text": ('"hello"', False, ["ROOT_TYPE"]),
    "root number": ("5", False, ["ROOT_TYPE"]),
    "empty object": (
        "{}",
        False,
        [f"MISSING:{rule.name}" for rule in CONTRACT if rule.required],
    ),
}


@pytest.fixture(scope="module")
def verdicts(spark):
    messages = bronze(spark, [text for text, _, _ in CASES.values()]).repartition(4).cache()
    lenient = {r.offset: r for r in gate.lenient_gate(messages).collect()}
    strict = {r.offset: r for r in gate.strict_gate(messages).collect()}
    messages.unpersist()
    return lenient, strict


@pytest.mark.parametrize("name", CASES)
def test_payload(verdicts, name):
    _, passes, reasons = CASES[name]
    offset = list(CASES).index(name)
    lenient, strict = (side[offset] for side in verdicts)
    assert lenient.is_bad is (not passes)
    assert lenient.reasons == ([] if passes else [LENIENT_REASON])
    assert strict.reasons == reasons
    assert strict.is_bad is bool(reasons)


@pytest.mark.parametrize("setting, value", [("spark.sql.ansi.enabled", "false")])
def test_verdicts_do_not_depend_on_settings(spark, verdicts, setting, value):
    messages = bronze(spark, [text for text, _, _ in CASES.values()])
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        for make, expected in zip((gate.lenient_gate, gate.strict_gate), verdicts):
            found = {r.offset: r.reasons for r in make(messages).collect()}
            assert found == {offset: row.reasons for offset, row in expected.items()}
    finally:
        spark.conf.set(setting, before)


def test_lenient_values(spark):
    """What the lenient parse makes of values that do not fit."""
    texts = [
        with_number("amount", "1200.00"),
        changed(amount={"v": 1}),
        changed(risk_score="80"),
        with_number("risk_score", "80.5"),
        with_number("risk_score", "80.0"),
        TEXT[:-1] + ', "amount": "9.00"}',
    ]
    rows = gate.flatten(bronze(spark, texts)).orderBy("offset").collect()
    assert [r.amount for r in rows[:2]] == ["1200.0", '{"v":1}']
    assert [r.risk_score for r in rows[2:5]] == [None, None, None]
    assert [r.currency for r in rows] == ["USD"] * 6
    assert rows[5].amount == "9.00"


def test_strict_keeps_what_it_accepts(spark):
    """Integers by value and times in every spelling RFC 3339 has: nothing becomes null."""
    texts = [
        with_number("risk_score", "95.0"),
        with_number("risk_score", "9e1"),
        with_number("schema_version", "9999999999"),
        changed(event_time="2024-03-01t10:00:00z"),
        changed(event_time="2016-12-31T23:59:60Z"),
        changed(event_time="2024-03-01T10:00:00+23:59"),
        changed(event_time="2024-03-01T10:00:00.25-23:59"),
        changed(amount="9" * 36 + ".99"),
    ]
    kept = gate.silver(gate.strict_gate(bronze(spark, texts)))
    rows = gate.typed(kept).withColumn("micros", F.unix_micros("event_time_ts")).orderBy("offset")
    found = rows.collect()
    assert len(found) == len(texts)
    assert [r.risk_score for r in found[:2]] == [95, 90]
    assert found[2].schema_version == 9999999999
    assert all(r.event_date is not None and r.amount_num is not None for r in found)
    noon = 1709287200
    seconds = [r.micros / 1e6 for r in found[3:7]]
    assert seconds == [noon, 1483228800, noon - 86340, noon + 86340.25]
    assert str(found[7].amount_num) == "9" * 36 + ".99"
    counted = gold.daily_metrics(kept).agg(F.sum("high_risk_txn_count")).first()[0]
    assert counted == 2


def test_quarantined_numbers_are_shown_as_parsed(spark):
    texts = [with_number("risk_score", "80.5"), changed(risk_score=101), changed(risk_score="7")]
    rows = gate.quarantine(gate.strict_gate(bronze(spark, texts))).orderBy("offset").collect()
    assert [r.risk_score for r in rows] == [None, 101, None]


def test_conditional_rule(spark):
    texts = [
        changed(status="failed", failure_reason="network_error"),
        changed(status="failed", failure_reason=None),
        without("failure_reason").replace('"settled"', '"failed"'),
        changed(failure_reason="network_error"),
        changed(failure_reason=7),
        TEXT,
    ]
    judged = gate.strict_gate(bronze(spark, texts), conditional=True).orderBy("offset").collect()
    broken = ["COND:failure_reason"]
    assert [r.reasons for r in judged] == [
        [],
        broken,
        broken,
        broken,
        ["TYPE:failure_reason"],
        [],
    ]


def test_routing_keeps_every_row_once(spark):
    messages = bronze(spark, [text for text, _, _ in CASES.values()])
    for make in gate.GATES.values():
        gated = make(messages)
        kept = {r.offset for r in gate.silver(gated).select("offset").collect()}
        failed = {r.offset for r in gate.quarantine(gated).select("offset").collect()}
        assert kept.isdisjoint(failed)
        assert kept | failed == set(range(len(CASES)))


def test_strict_passes_are_lenient_passes(verdicts):
    lenient, strict = verdicts
    kept = {offset for offset, row in strict.items() if not row.is_bad}
    assert kept <= {offset for offset, row in lenient.items() if not row.is_bad}


def test_layer_columns(spark):
    messages = bronze(spark, [TEXT, TEXT[:-1]])
    stamp = F.timestamp_micros(F.lit(0))
    gated = gate.lenient_gate(messages)
    assert gate.silver(gated).columns == list(gate.SILVER_COLUMNS)
    assert len(gate.SILVER_COLUMNS) == 22
    assert gate.quarantine(gated).columns == [*gate.QUARANTINE_COLUMNS, "reasons"]
    assert len(gate.QUARANTINE_COLUMNS) == 23
    bad = gate.quarantine(gated, stamp).first()
    assert bad.raw_value == TEXT[:-1]
    assert bad.error_reason == LENIENT_REASON
    assert bad.quarantined_at.year == 1970


def test_reason_counts(spark):
    gated = gate.strict_gate(bronze(spark, [changed(q=1), changed(q=1, currency="x"), TEXT]))
    counts = {r.reason: r.row_count for r in gate.reason_counts(gate.quarantine(gated)).collect()}
    assert counts == {"EXTRA:q": 2, "PATTERN:currency": 1}
