"""SQL that rebuilds each query's result on its own, for DuckDB.

It makes the raw messages from ``events`` itself and parses them with DuckDB's JSON
functions, so it shares no code path with the Spark side.
"""

from __future__ import annotations

# --- Fixed values: the event's fields, as in the contract ------------------
FIELDS = [
    "event_id",
    "transaction_id",
    "user_id",
    "merchant_id",
    "amount",
    "currency",
    "payment_method",
    "transaction_type",
    "status",
    "failure_reason",
    "event_time",
    "ingested_at",
    "risk_score",
    "source_system",
    "schema_version",
]
REQUIRED = [name for name in FIELDS if name not in ("failure_reason", "risk_score")]
INTEGERS = ["risk_score", "schema_version"]
TEXTS = [name for name in FIELDS if name not in INTEGERS]
LENIENT_REQUIRED = [
    "event_id",
    "transaction_id",
    "user_id",
    "merchant_id",
    "amount",
    "currency",
    "status",
    "event_time",
]
DROPPABLE = ["amount", "currency", "status", "event_time", "transaction_id"]
DATE_TIME = (
    "[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:"
    "([0-5][0-9]|60)([.][0-9]+)?([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])"
)


def _list(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


# --- The intact message, one column per field holding its JSON text --------
_EVENTS = """
ev AS (
  SELECT *,
    CASE WHEN event_id % 10 <> 0 THEN 0 ELSE (event_id // 10) % 5 + 1 END AS mode,
    event_id // 50 AS pick,
    CASE WHEN event_id % 10 <> 0 THEN -1 ELSE (event_id // 10) % 19 END AS fault,
    event_id // 190 AS choice,
    CASE event_type WHEN 'signup' THEN 'transaction_created'
      WHEN 'view' THEN 'transaction_authorized' WHEN 'click' THEN 'transaction_authorized'
      WHEN 'error' THEN 'transaction_failed' WHEN 'purchase' THEN 'transaction_settled'
    END AS lifecycle_type,
    CASE event_type WHEN 'signup' THEN 'initiated' WHEN 'view' THEN 'authorized'
      WHEN 'click' THEN 'authorized' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'settled'
    END AS life_status,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS money_text
  FROM events
)"""

_INTACT = {
    "event_id": """'"evt_' || event_id || '"'""",
    "transaction_id": """'"txn_' || event_id || '"'""",
    "user_id": """'"usr_' || user_id || '"'""",
    "merchant_id": """'"mrc_' || (user_id % 50) || '"'""",
    "amount": """'"' || money_text || '"'""",
    "currency": """'"' || (['USD', 'INR', 'EUR'])[event_id % 3 + 1] || '"'""",
    "payment_method": """'"' || (['card', 'ach', 'wire', 'wallet'])[event_id % 4 + 1] || '"'""",
    "transaction_type": """'"' || (['purchase', 'refund', 'payout', 'transfer'])"""
    """[(event_id // 4) % 4 + 1] || '"'""",
    "status": """'"' || life_status || '"'""",
    "failure_reason": """CASE WHEN life_status = 'failed' THEN '"' || (['insufficient_funds', """
    """'suspected_fraud', 'network_error', 'invalid_account', 'limit_exceeded'])"""
    """[event_id % 5 + 1] || '"' ELSE 'null' END""",
    "event_time": """'"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"'""",
    "ingested_at": """'"' || strftime(ts + to_seconds(event_id % 7), """
    """'%Y-%m-%dT%H:%M:%S.%fZ') || '"'""",
    "risk_score": """CASE WHEN event_id % 13 = 0 THEN 'null'"""
    """ ELSE CAST(event_id % 101 AS VARCHAR) END""",
    "source_system": """'"sim"'""",
    "schema_version": """'1'""",
}
_EXTRA = '"unexpected_field": {"nested": true}'


def _spread(names, fault: int, text: str) -> list[tuple[str, str, str]]:
    """(field, condition, JSON text) for a fault that goes round a list of fields."""
    return [
        (name, f"fault = {fault} AND choice % {len(names)} = {index}", text)
        for index, name in enumerate(names)
    ]


def _choice(values) -> str:
    return f"""'"' || ({_list(values)})[choice % {len(values)} + 1] || '"'"""


_BAD_TIMES = [
    "2024-13-01T00:00:00Z",
    "2024-02-30T00:00:00Z",
    "2024-01-01 00:00:00Z",
    "2024-01-01",
    "2024-01-01T24:00:00Z",
    "yesterday",
]
_DAMAGE = {
    "simulated": [
        *[
            (name, f"mode = 1 AND pick % 5 = {index}", "NULL")
            for index, name in enumerate(DROPPABLE)
        ],
        ("amount", "mode = 2", "money_text"),
        ("currency", "mode = 3 AND pick % 2 = 0", "'\"usd\"'"),
        ("status", "mode = 3 AND pick % 2 = 1", "'\"authorised\"'"),
    ],
    "contract": [
        *_spread(REQUIRED, 0, "NULL"),
        *_spread(TEXTS, 1, "'12.5'"),
        *_spread(REQUIRED, 2, "'null'"),
        *_spread(INTEGERS, 3, "'\"7\"'"),
        *_spread(INTEGERS, 4, "'80.5'"),
        *_spread(INTEGERS, 5, "'80.0'"),
        ("amount", "fault = 6", _choice(["-5.00", "1e3", "12.5", ".50", "12.345", "1,000.00"])),
        ("currency", "fault = 7", _choice(["usd", "US", "USDX", "U5D"])),
        *_spread(["payment_method", "transaction_type", "status"], 8, "'\"unheard_of\"'"),
        ("event_time", "fault = 9", _choice(_BAD_TIMES)),
        ("ingested_at", "fault = 10", _choice(_BAD_TIMES)),
        ("risk_score", "fault = 11", "(['-1', '101'])[choice % 2 + 1]"),
        ("schema_version", "fault = 12", "(['0', '-3'])[choice % 2 + 1]"),
        ("amount", "fault = 15", "NULL"),
        ("currency", "fault = 15", "'\"usd\"'"),
        ("risk_score", "fault = 15", "'101'"),
        (
            "failure_reason",
            "fault = 16",
            "CASE WHEN life_status = 'failed' THEN 'null' ELSE '\"network_error\"' END",
        ),
        (
            "event_time",
            "fault = 17",
            """'"' || strftime(ts, '%Y-%m-%d') || (['T23:59:60Z', 't10:00:00z', """
            """'T10:00:00+23:59', 'T10:00:00.5-18:30'])[choice % 4 + 1] || '"'""",
        ),
        (
            "risk_score",
            "fault = 18 AND choice % 2 = 0",
            "(['95.0', '9e1', '1e2', '80.0'])[(choice // 2) % 4 + 1]",
        ),
        ("schema_version", "fault = 18 AND choice % 2 = 1", "'9999999999'"),
    ],
}
_EXTRA_MEMBER = {
    "simulated": f"CASE WHEN mode = 4 THEN '{_EXTRA}' END",
    "contract": f"CASE WHEN fault = 15 THEN '{_EXTRA}' WHEN fault = 13 AND choice % 2 = 0 "
    f"THEN '{_EXTRA}' WHEN fault = 13 THEN '\"channel\": \"web\", {_EXTRA}' END",
}
_WHOLE = {
    "simulated": "CASE WHEN mode = 5 THEN left(body, length(body) - 1) ELSE body END",
    "contract": "CASE WHEN fault = 14 THEN CASE choice % 4 "
    "WHEN 0 THEN left(body, length(body) - 1) WHEN 1 THEN '[' || body || ']' "
    "WHEN 2 THEN '\"hello\"' ELSE 'null' END ELSE body END",
}


def _messages(payload: str) -> str:
    """CTEs ending in ``bronze``: the raw messages with their envelope."""
    members = []
    for name in FIELDS:
        damage = [(when, text) for field, when, text in _DAMAGE[payload] if field == name]
        cases = " ".join(f"WHEN {when} THEN {text}" for when, text in damage)
        token = f"CASE {cases} ELSE {_INTACT[name]} END" if cases else _INTACT[name]
        members.append(f"'\"{name}\": ' || ({token})")
    members.append(_EXTRA_MEMBER[payload])
    return f"""{_EVENTS},
bodies AS (
  SELECT *, '{{' || concat_ws(', ', {', '.join(members)}) || '}}' AS body FROM ev
),
bronze AS (
  SELECT 'fintech_transactions' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
    event_id AS "offset", ts + to_seconds(event_id % 11) AS kafka_timestamp,
    'txn_' || event_id AS kafka_key, {_WHOLE[payload]} AS raw_value,
    ts + to_seconds(event_id % 11) + to_seconds(event_id % 60) AS ingested_at,
    CAST(ts + to_seconds(event_id % 11) + to_seconds(event_id % 60) AS DATE) AS ingest_date,
    mode, ts
  FROM bodies
)"""


# --- Reading the messages back ---------------------------------------------
_NEEDED = " OR ".join(f"{name} IS NULL" for name in LENIENT_REQUIRED)


def _flat(payload: str, source: str = "bronze") -> str:
    """CTEs ending in ``flat``: each message's fields as the lenient parse sees them."""
    fields = []
    for name in FIELDS:
        text = f"json_extract_string(doc, '$.{name}')"
        if name in INTEGERS:
            whole = f"json_type(doc, '$.{name}') IN ('UBIGINT', 'BIGINT')"
            text = f"CASE WHEN {whole} THEN CAST(TRY_CAST({text} AS INTEGER) AS BIGINT) END"
        elif name == "ingested_at":
            # Bronze has a column of that name; the event's own is meant here.
            text = f"json_extract_string(doc, '$.{name}')"
        fields.append(f"{text} AS {name}")
    return f"""{_messages(payload)},
docs AS (
  SELECT topic, "partition", "offset", raw_value, kafka_timestamp,
    ingested_at AS bronze_ingested_at, ingest_date, mode,
    CASE WHEN json_valid(raw_value) THEN CAST(raw_value AS JSON) END AS doc
  FROM {source}
),
fields AS (
  SELECT topic, "partition", "offset", raw_value, kafka_timestamp, bronze_ingested_at,
    ingest_date, mode, doc, {', '.join(fields)}
  FROM docs
),
flat AS (
  SELECT *, ({_NEEDED}) AS is_bad, TRY_CAST(amount AS DECIMAL(38,2)) AS amount_num,
    TRY_CAST(left(event_time, 10) AS DATE) AS event_date,
    TRY_CAST(replace(event_time, 'Z', '') AS TIMESTAMP) AS event_time_ts
  FROM fields
),
silver AS (
  SELECT *, bronze_ingested_at + to_seconds(90 + "offset" % 30) AS silver_loaded_at
  FROM flat WHERE NOT is_bad
),
quarantine AS (
  SELECT *, 'SCHEMA_OR_REQUIRED_FIELD_FAILURE' AS error_reason FROM flat WHERE is_bad
)"""


_SHOWN = ", ".join(
    "CAST(amount_num AS DOUBLE) AS amount" if name == "amount" else name for name in FIELDS
)
_EVENT = f'"partition", "offset", {_SHOWN}'


def _judged(payload: str, conditional: bool = False, source: str = "bronze") -> str:
    """CTEs ending in ``judged``: each message with its list of broken contract rules."""

    def kind(name: str) -> str:
        return f"json_type(doc, '$.{name}')"

    def text(name: str) -> str:
        return f"json_extract_string(doc, '$.{name}')"

    def type_ok(name: str) -> str:
        if name in TEXTS:
            ok = f"{kind(name)} = 'VARCHAR'"
        else:
            number = f"TRY_CAST({text(name)} AS DOUBLE)"
            ok = (
                f"({kind(name)} IN ('UBIGINT', 'BIGINT') OR "
                f"({kind(name)} = 'DOUBLE' AND {number} = floor({number})))"
            )
        if name in ("failure_reason", "risk_score"):
            ok = f"({ok} OR {kind(name)} = 'NULL')"
        return ok

    def judged_value(name: str, ok: str) -> str:
        present = f"{kind(name)} IS NOT NULL AND {kind(name)} <> 'NULL' AND {type_ok(name)}"
        return f"({present}) AND NOT ({ok})"

    def date_time(name: str) -> str:
        return (
            f"(regexp_full_match({text(name)}, '{DATE_TIME}') AND "
            f"TRY_CAST(left({text(name)}, 10) AS DATE) IS NOT NULL)"
        )

    def number(name: str) -> str:
        return f"TRY_CAST({text(name)} AS DOUBLE)"

    rules = [(f"MISSING:{name}", f"{kind(name)} IS NULL") for name in REQUIRED]
    rules += [
        (f"TYPE:{name}", f"{kind(name)} IS NOT NULL AND NOT {type_ok(name)}") for name in FIELDS
    ]
    values = {
        "amount": ("PATTERN", f"regexp_full_match({text('amount')}, '[0-9]+([.][0-9]{{2}})?')"),
        "currency": ("PATTERN", f"regexp_full_match({text('currency')}, '[A-Z]{{3}}')"),
        "payment_method": (
            "ENUM",
            f"{text('payment_method')} IN {_in(['card', 'ach', 'wire', 'wallet'])}",
        ),
        "transaction_type": (
            "ENUM",
            f"{text('transaction_type')} IN {_in(['purchase', 'refund', 'payout', 'transfer'])}",
        ),
        "status": (
            "ENUM",
            f"{text('status')} IN {_in(['initiated', 'authorized', 'failed', 'settled'])}",
        ),
        "event_time": ("FORMAT", date_time("event_time")),
        "ingested_at": ("FORMAT", date_time("ingested_at")),
        "risk_score": ("RANGE", f"{number('risk_score')} BETWEEN 0 AND 100"),
        "schema_version": ("RANGE", f"{number('schema_version')} >= 1"),
    }
    rules += [
        (f"{prefix}:{name}", judged_value(name, ok)) for name, (prefix, ok) in values.items()
    ]
    if conditional:
        given = f"coalesce({kind('failure_reason')}, 'NULL')"
        rules.append(
            (
                "COND:failure_reason",
                f"{kind('status')} = 'VARCHAR' AND {given} IN ('VARCHAR', 'NULL') AND "
                f"({text('status')} = 'failed') <> ({given} = 'VARCHAR')",
            )
        )
    broken = ", ".join(f"CASE WHEN {when} THEN '{code}' END" for code, when in rules)
    exact = ", ".join(
        f"CASE WHEN len(reasons) = 0 THEN TRY_CAST({number(name)} AS BIGINT) ELSE {name} END "
        f"AS {name}"
        for name in INTEGERS
    )
    return f"""{_flat(payload, source)},
verdicts AS (
  SELECT *, CASE
      WHEN doc IS NULL THEN ['MALFORMED_JSON']
      WHEN json_type(doc) <> 'OBJECT' THEN ['ROOT_TYPE']
      ELSE list_concat(
        [x FOR x IN [{broken}] IF x IS NOT NULL],
        ['EXTRA:' || k FOR k IN list_sort(json_keys(doc)) IF k NOT IN {_in(FIELDS)}])
    END AS reasons
  FROM flat
),
judged AS (SELECT * REPLACE ({exact}) FROM verdicts)"""


def _rule(*prefixes: str, conditional: bool = False) -> str:
    return f"""WITH {_judged("contract", conditional)},
broken AS (SELECT "offset", unnest(reasons) AS reason FROM judged)
SELECT "offset", reason FROM broken WHERE split_part(reason, ':', 1) IN {_in(prefixes)}"""


_HALF_SECOND = """(SELECT * REPLACE (CASE WHEN "offset" % 20 < 10
    THEN replace(raw_value, '"schema_version": 1', '"schema_version": 2')
    ELSE raw_value END AS raw_value) FROM bronze)"""
_VERSIONS = f"""WITH {_judged("contract", source=_HALF_SECOND)},
named AS (
  SELECT "offset", doc, reasons,
    coalesce(json_type(doc, '$.schema_version') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
      AND TRY_CAST(json_extract_string(doc, '$.schema_version') AS DOUBLE) = 2, false) AS second
  FROM verdicts
),
first_rules AS (SELECT "offset", second, unnest(reasons) AS reason FROM named)
SELECT "offset", reason FROM first_rules WHERE NOT (second AND reason = 'EXTRA:channel')
UNION ALL
SELECT "offset", 'ENUM:currency' FROM named
WHERE second AND json_type(doc, '$.currency') = 'VARCHAR'
  AND json_extract_string(doc, '$.currency') NOT IN ('USD', 'EUR')
UNION ALL
SELECT "offset", 'RANGE:risk_score' FROM named
WHERE second AND json_type(doc, '$.risk_score') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
  AND TRY_CAST(json_extract_string(doc, '$.risk_score') AS DOUBLE) > 50
  AND TRY_CAST(json_extract_string(doc, '$.risk_score') AS DOUBLE) <= 100
  AND NOT list_contains(reasons, 'TYPE:risk_score')"""


# --- Gold -------------------------------------------------------------------
_MEASURES = {
    "transaction_count": "count(*) AS transaction_count",
    "total_amount": "CAST(sum(amount_num) AS DOUBLE) AS total_amount",
    "avg_amount": "CAST(sum(amount_num) AS DOUBLE) / nullif(count(amount_num), 0) AS avg_amount",
    "high_risk_txn_count": "CAST(sum(CASE WHEN risk_score >= 80 THEN 1 ELSE 0 END) AS BIGINT)"
    " AS high_risk_txn_count",
}


def _gold_select(*measures: str, source: str = "silver") -> str:
    shown = ", ".join(_MEASURES[name] for name in measures or _MEASURES)
    return (
        f"SELECT event_date, currency, status, {shown} FROM {source} "
        "GROUP BY event_date, currency, status"
    )


_LENIENT = f"WITH {_flat('simulated')}"
_GOLD = f"{_LENIENT}, gold AS ({_gold_select()})"


# --- Check reports ----------------------------------------------------------
def _check(dataset, source, metric, column, op, threshold, value, holds) -> str:
    subject = f"{metric}({column})" if column else metric
    shown = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{dataset}' AS dataset, '{subject} {op} {threshold}' AS check_id,
  '{metric}' AS metric, {shown} AS column_name, '{op}' AS op,
  CAST({threshold} AS DOUBLE) AS threshold, value,
  CASE WHEN {holds} THEN 'PASS' ELSE 'FAIL' END AS outcome
FROM (SELECT CAST({value} AS DOUBLE) AS value FROM {source})"""


def _rows_check(dataset, source) -> str:
    return _check(dataset, source, "row_count", None, ">", 0, "count(*)", "value > 0")


def _missing_check(dataset, source, column) -> str:
    value = f"count(*) FILTER (WHERE {column} IS NULL)"
    return _check(dataset, source, "missing_count", column, "=", 0, value, "value = 0")


def _invalid_check(dataset, source, column) -> str:
    value = f"count(*) FILTER (WHERE {column} < 0)"
    return _check(dataset, source, "invalid_count", column, "=", 0, value, "value = 0")


_SILVER_SET, _QUARANTINE_SET, _GOLD_SET = (
    "silver_fintech_transactions",
    "quarantine_fintech_transactions",
    "gold_daily_transaction_metrics",
)
_ROWS = {
    _SILVER_SET: [_rows_check(_SILVER_SET, "silver")],
    _QUARANTINE_SET: [_rows_check(_QUARANTINE_SET, "quarantine")],
    _GOLD_SET: [_rows_check(_GOLD_SET, "gold")],
}
_MISSING = {
    _SILVER_SET: [
        _missing_check(_SILVER_SET, "silver", column)
        for column in ("transaction_id", "event_time", "currency", "status")
    ],
    _QUARANTINE_SET: [
        _missing_check(_QUARANTINE_SET, "quarantine", column)
        for column in ("error_reason", "raw_value")
    ],
    _GOLD_SET: [
        _missing_check(_GOLD_SET, "gold", column) for column in ("event_date", "currency", "status")
    ],
}
_INVALID = {
    _SILVER_SET: [_invalid_check(_SILVER_SET, "silver", "amount_num")],
    _QUARANTINE_SET: [],
    _GOLD_SET: [
        _invalid_check(_GOLD_SET, "gold", column)
        for column in ("transaction_count", "total_amount", "avg_amount", "high_risk_txn_count")
    ],
}


_FRESH = _check(
    _SILVER_SET,
    "silver",
    "freshness",
    "event_time_ts",
    "<",
    3600,
    "(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_time_ts))) / 1e6",
    "value < 3600",
)


def _report(prefix: str, checks) -> str:
    return f"{prefix} " + " UNION ALL ".join(checks)


def _all_sets(family) -> str:
    return _report(_GOLD, [check for checks in family.values() for check in checks])


def _one_set(name: str) -> str:
    return _report(_GOLD, _ROWS[name] + _MISSING[name] + _INVALID[name])


# --- One entry per query ----------------------------------------------------
_BRONZE = f"WITH {_messages('simulated')}"
_PER_PARTITION = f"""{_BRONZE}
SELECT topic, "partition", count(*) AS row_count, min("offset") AS first_offset,
  max("offset") AS last_offset, CAST(sum(length(raw_value)) AS BIGINT) AS text_length
FROM bronze GROUP BY topic, "partition\""""


def _lag(stage: str, start: str, end: str) -> str:
    seconds = f"((epoch_us({end}) - epoch_us({start})) / 1e6)"
    return (
        f"round(avg({seconds}), 3) AS {stage}_avg, "
        f"quantile_disc({seconds}, 0.95) AS {stage}_p95, max({seconds}) AS {stage}_max"
    )


ORACLES: dict[str, str] = {
    "bronze_fixture_modes": f"""{_BRONZE}
SELECT "offset", CAST(mode AS INTEGER) AS mode, raw_value FROM bronze""",
    "bronze_envelope": f"""WITH {_messages('contract')}
SELECT topic, "partition", "offset", epoch_us(kafka_timestamp) AS kafka_micros, kafka_key,
  raw_value, epoch_us(ingested_at) AS ingested_micros FROM bronze""",
    "bronze_partition_helpers": f"""{_BRONZE}
SELECT ingest_date, strftime(ingested_at, '%Y-%m-%d-%H') AS ingest_hour, count(*) AS row_count
FROM bronze GROUP BY 1, 2""",
    "bronze_scan": _PER_PARTITION,
    "bronze_day_slice": f"""{_BRONZE}
SELECT ingest_date, count(*) AS row_count, CAST(sum("offset") AS BIGINT) AS offset_sum
FROM bronze WHERE ingest_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
GROUP BY ingest_date""",
    "bronze_parse": f"WITH {_flat('contract')} SELECT {_EVENT} FROM flat",
    "silver_flatten": f"{_LENIENT} SELECT raw_value, {_EVENT} FROM flat",
    "required_missing_flags": f"""WITH {_flat('contract')}
SELECT "offset", {', '.join(f'{name} IS NULL AS no_{name}' for name in LENIENT_REQUIRED)}, is_bad
FROM flat""",
    "silver_lenient": f"{_LENIENT} SELECT {_EVENT} FROM silver",
    "quarantine_lenient": f"{_LENIENT} SELECT raw_value, error_reason, {_EVENT} FROM quarantine",
    "silver_strict": f"""WITH {_judged('contract')}
SELECT {_EVENT} FROM judged WHERE len(reasons) = 0""",
    "quarantine_strict": f"""WITH {_judged('contract')}
SELECT "offset", raw_value, array_to_string(reasons, ',') AS error_reason
FROM judged WHERE len(reasons) > 0""",
    "quarantine_reason_counts": f"""WITH {_judged('simulated')},
broken AS (SELECT unnest(reasons) AS reason FROM judged)
SELECT reason, count(*) AS row_count FROM broken GROUP BY reason""",
    "contract_malformed": _rule("MALFORMED_JSON", "ROOT_TYPE"),
    "contract_required": _rule("MISSING"),
    "contract_types": _rule("TYPE"),
    "contract_patterns": _rule("PATTERN"),
    "contract_enums": _rule("ENUM"),
    "contract_formats": _rule("FORMAT"),
    "contract_ranges": _rule("RANGE"),
    "contract_versions": _VERSIONS,
    "contract_extra_keys": _rule("EXTRA"),
    "contract_conditional": _rule("COND", conditional=True),
    "silver_typed": f"""{_LENIENT}
SELECT "offset", CAST(amount_num AS DOUBLE) AS amount_num,
  epoch_us(event_time_ts) AS event_time_micros, event_date FROM silver""",
    "audit_stamps": f"""{_LENIENT},
stamps AS (
  SELECT "offset", is_bad,
    epoch_us(bronze_ingested_at + to_seconds(90 + "offset" % 30)) AS stamp FROM flat
)
SELECT "offset", CASE WHEN is_bad THEN 'quarantine' ELSE 'silver' END AS layer,
  CASE WHEN NOT is_bad THEN stamp END AS loaded_micros,
  CASE WHEN is_bad THEN stamp END AS quarantined_micros FROM stamps""",
    "lifecycle_status": f"""WITH {_EVENTS}
SELECT event_id, lifecycle_type, life_status AS status, life_status = 'failed' AS is_failure
FROM ev""",
    "gold_daily_metrics": f"{_LENIENT} {_gold_select()}",
    "gold_daily_metrics_double": f"""{_LENIENT}
SELECT event_date, currency, status, count(*) AS transaction_count,
  round(sum(TRY_CAST(amount AS DOUBLE)), 4) AS total_amount,
  round(avg(TRY_CAST(amount AS DOUBLE)), 8) AS avg_amount,
  CAST(sum(CASE WHEN risk_score >= 80 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_txn_count
FROM silver GROUP BY event_date, currency, status""",
    "gold_strict_metrics": f"""WITH {_judged('simulated')},
kept AS (SELECT * FROM judged WHERE len(reasons) = 0) {_gold_select(source='kept')}""",
    "gold_txn_count": f"{_LENIENT} {_gold_select('transaction_count')}",
    "gold_amount_sum": f"{_LENIENT} {_gold_select('total_amount')}",
    "gold_amount_avg": f"{_LENIENT} {_gold_select('avg_amount')}",
    "high_risk_count": f"{_LENIENT} {_gold_select('high_risk_txn_count')}",
    "gold_preview": f"""{_GOLD}
SELECT * FROM gold ORDER BY event_date NULLS FIRST, currency NULLS FIRST, status NULLS FIRST
LIMIT 50""",
    "quarantine_preview": f"""{_LENIENT}
SELECT error_reason, raw_value, event_id, transaction_id, user_id,
  CAST(amount_num AS DOUBLE) AS amount, currency, status, event_time
FROM quarantine ORDER BY topic, "partition", "offset" LIMIT 50""",
    "dq_row_count": _all_sets(_ROWS),
    "dq_missing_count": _all_sets(_MISSING),
    "dq_invalid_min": _all_sets(_INVALID),
    "dq_freshness": f"{_LENIENT} {_FRESH}",
    "dq_scan_merged": _report(
        _GOLD,
        [
            check
            for name in (_SILVER_SET, _QUARANTINE_SET, _GOLD_SET)
            for check in _ROWS[name] + _MISSING[name] + _INVALID[name]
        ]
        + [_FRESH],
    ),
    "dq_scan_silver": _one_set(_SILVER_SET),
    "dq_scan_quarantine": _one_set(_QUARANTINE_SET),
    "dq_scan_gold": _one_set(_GOLD_SET),
    "dq_scan_customer": _report(
        "",
        [
            _rows_check("customer", "customer"),
            _missing_check("customer", "customer", "c_acctbal"),
            _invalid_check("customer", "customer", "c_acctbal"),
        ],
    ),
    "layer_conservation": f"""{_GOLD},
sizes AS (
  SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
    (SELECT count(*) FROM silver) AS silver_rows,
    (SELECT count(*) FROM quarantine) AS quarantine_rows,
    (SELECT CAST(sum(transaction_count) AS BIGINT) FROM gold) AS gold_rows
)
SELECT *, CASE WHEN bronze_rows = silver_rows + quarantine_rows AND gold_rows = silver_rows
  THEN 'PASS' ELSE 'FAIL' END AS outcome FROM sizes""",
    "silver_incremental": f"""{_LENIENT}
SELECT {_EVENT} FROM silver WHERE ingest_date > DATE '2024-01-20'""",
    "silver_dedup": f"{_LENIENT} SELECT {_EVENT} FROM silver",
    "layer_lag": f"""{_LENIENT}
SELECT topic, count(*) AS row_count,
  {_lag('event_to_kafka', 'event_time_ts', 'kafka_timestamp')},
  {_lag('kafka_to_bronze', 'kafka_timestamp', 'bronze_ingested_at')},
  {_lag('bronze_to_silver', 'bronze_ingested_at', 'silver_loaded_at')}
FROM silver GROUP BY topic""",
    "layer_roundtrip": f"""{_GOLD}
SELECT 'silver' AS layer, count(*) AS row_count, CAST(sum("offset") AS BIGINT) AS total FROM silver
UNION ALL
SELECT 'quarantine', count(*), CAST(sum("offset") AS BIGINT) FROM quarantine
UNION ALL
SELECT 'gold', count(*), CAST(sum(transaction_count) AS BIGINT) FROM gold""",
    "gold_csv_export": f"{_LENIENT} {_gold_select()}",
    "stream_bronze_append": f"""{_BRONZE}
SELECT "partition", "offset", kafka_key, raw_value, ingest_date FROM bronze""",
    "stream_restart_exactly_once": _PER_PARTITION,
    "stream_silver_split": f"""WITH {_judged('simulated')}
SELECT CASE WHEN len(reasons) > 0 THEN 'quarantine' ELSE 'silver' END AS layer,
  CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, ',') END AS error_reason,
  raw_value, "offset" FROM judged""",
    "stream_first_deliveries": f"{_LENIENT} SELECT {_SHOWN} FROM silver",
    "stream_gold_windowed": f"{_LENIENT} {_gold_select()}",
    "gold_incremental": f"{_LENIENT} {_gold_select()}",
    "stream_shifted_repeats": f"{_LENIENT} SELECT {_EVENT} FROM silver",
    "load_after_crashes": f"""{_LENIENT}, gold AS ({_gold_select()})
SELECT 'silver' AS layer, CAST(bronze_ingested_at AS DATE) AS day, count(*) AS row_count
FROM silver GROUP BY 2
UNION ALL
SELECT 'quarantine', CAST(bronze_ingested_at AS DATE), count(*) FROM quarantine GROUP BY 2
UNION ALL
SELECT 'gold', event_date, CAST(sum(transaction_count) AS BIGINT) FROM gold GROUP BY 2""",
    "offset_ranges": f"""WITH {_messages('simulated')}, runs AS (
  SELECT ingest_date, "partition", "offset",
    "offset" - row_number() OVER (PARTITION BY ingest_date, "partition" ORDER BY "offset") AS run
  FROM bronze
)
SELECT ingest_date, "partition", min("offset") AS first, max("offset") AS last,
  CAST(1 AS BIGINT) AS copies
FROM runs GROUP BY ingest_date, "partition", run""",
    "offset_differences": f"""WITH {_messages('simulated')}
SELECT ingest_date, "partition", "offset" AS first, "offset" AS last,
  CAST(CASE WHEN "offset" // 4 % 10 = 4 THEN 0 ELSE 1 END AS BIGINT) AS missing,
  CAST(CASE WHEN "offset" // 4 % 10 = 4 THEN 2 ELSE 0 END AS BIGINT) AS surplus
FROM bronze WHERE "offset" // 40 % 7 = 0 AND "offset" // 4 % 10 IN (3, 4, 5)""",
    "layer_replay": f"""{_LENIENT}
SELECT CASE WHEN is_bad THEN 'quarantine' ELSE 'silver' END AS layer, count(*) AS row_count,
  CAST(sum("offset") AS BIGINT) AS offset_sum FROM flat GROUP BY 1""",
    "silver_strict_typed": f"""WITH {_judged('contract')},
parts AS (
  SELECT "offset", event_time, event_date, substr(event_time, 18, 2) = '60' AS leap,
    regexp_extract(event_time, '([.][0-9]+)', 1) AS fraction,
    regexp_extract(event_time, '([+-][0-9]{{2}}:[0-9]{{2}})$', 1) AS zone
  FROM judged WHERE len(reasons) = 0
)
SELECT "offset", event_date,
  epoch_us(CAST(left(event_time, 10) || ' ' || substr(event_time, 12, 5) || ':' ||
      CASE WHEN leap THEN '59' ELSE substr(event_time, 18, 2) END || fraction AS TIMESTAMP))
    + CASE WHEN leap THEN 1000000 ELSE 0 END
    - CASE WHEN zone = '' THEN 0 ELSE CASE WHEN left(zone, 1) = '-' THEN -1 ELSE 1 END
        * (CAST(substr(zone, 2, 2) AS BIGINT) * 3600 + CAST(substr(zone, 5, 2) AS BIGINT) * 60)
        * 1000000 END AS event_time_micros
FROM parts""",
    "high_risk_count_strict": f"""WITH {_judged('contract')},
kept AS (SELECT * FROM judged WHERE len(reasons) = 0)
{_gold_select('high_risk_txn_count', source='kept')}""",
    "dq_clean_load": f"""{_LENIENT},
none AS (SELECT * FROM quarantine WHERE false) """
    + " UNION ALL ".join(
        _missing_check(_QUARANTINE_SET, "none", column) for column in ("error_reason", "raw_value")
    ),
    "dq_invalid_nan": f"""{_LENIENT},
odd AS (
  SELECT CASE "offset" % 97 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN -1
    ELSE TRY_CAST(amount AS DOUBLE) END AS amount_num FROM silver
) """
    + _check(
        _SILVER_SET, "odd", "invalid_count", "amount_num", "=", 0,
        "count(*) FILTER (WHERE isnan(amount_num) OR amount_num < 0)", "value = 0",
    ),
}
