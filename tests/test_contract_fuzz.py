"""The strict gate against a plain reading of the contract, on thousands of messages."""

from __future__ import annotations

import datetime
import json
import random
import re
from decimal import Decimal

from test_gate import GOOD, bronze

from tallygate.functions import contract
from tallygate.functions.event_model import CONTRACT, EVENT_FIELDS
from tallygate.operators import gate

MESSAGES = 4000
VALUES = [
    "", "x", "USD", "usd", "card", "failed", "authorised", "12.50", "12.5", "0", "-1.00", "7\n",
    "2024-02-29T23:59:60+05:30", "2023-02-29T00:00:00Z", "2024-01-01T00:00:00.123456789z", "]", "}",
    "2024-01-01T00:00:00+24:00", "é", '"', "\\", "a\tb", None, True, False, 0, 1, -1, 100, 101,
    3000000000, 10**25, 12.5, 80.0, 1e2, 1e300, -0.0, [], [1], {}, {"a": [None]}, [[{"k": "]"}]],
]
KEYS = ["zeta", "alpha", "a b", "a.b", "é", "", "Amount", "amount ", "a: BIGINT, b", "$", "[0]"]
TAILS = ["", " ", "\n\t", "]", "}", ",", " {}", ",{}", "]x", "}x", "x", "]]", ']}', ', "q": 1}']
HEADS = ["", " ", "\n", "[", "x", "1],[", '"a",', "null "]


class Malformed(ValueError):
    pass


def _object(pairs):
    keys = [key for key, _ in pairs]
    if len(set(keys)) < len(keys):
        raise Malformed
    return dict(pairs)


def _constant(_):
    raise Malformed


def _is_text(value):
    return isinstance(value, str)


def _is_integer(value):
    if isinstance(value, bool):
        return False
    return isinstance(value, int) or (isinstance(value, Decimal) and value == int(value))


def _is_date_time(value):
    if not re.fullmatch(contract.DATE_TIME.replace(r"\A", "").replace(r"\z", ""), value):
        return False
    try:
        datetime.date.fromisoformat(value[:10])
    except ValueError:
        return False
    return True


def judge(text):
    """Reason codes by the book."""
    try:
        event = json.loads(
            text, object_pairs_hook=_object, parse_constant=_constant, parse_float=Decimal
        )
    except ValueError:
        return ["MALFORMED_JSON"]
    if not isinstance(event, dict):
        return ["ROOT_TYPE"]
    missing, types, values = [], [], []
    for rule in CONTRACT:
        if rule.name not in event:
            if rule.required:
                missing.append(f"MISSING:{rule.name}")
            continue
        value = event[rule.name]
        if value is None and rule.nullable:
            continue
        if not (_is_text if rule.kind == "string" else _is_integer)(value):
            types.append(f"TYPE:{rule.name}")
            continue
        pattern = rule.pattern and rule.pattern.replace(r"\A", "").replace(r"\z", "")
        if pattern and not re.fullmatch(pattern, value):
            values.append(f"PATTERN:{rule.name}")
        if rule.allowed and value not in rule.allowed:
            values.append(f"ENUM:{rule.name}")
        if rule.date_time and not _is_date_time(value):
            values.append(f"FORMAT:{rule.name}")
        below = rule.minimum is not None and value < rule.minimum
        above = rule.maximum is not None and value > rule.maximum
        if below or above:
            values.append(f"RANGE:{rule.name}")
    extra = [f"EXTRA:{key}" for key in sorted(set(event) - set(EVENT_FIELDS))]
    return missing + types + values + extra


def message(chance: random.Random) -> str:
    event = dict(GOOD)
    for _ in range(chance.choice([0, 1, 1, 2, 3])):
        name = chance.choice(EVENT_FIELDS)
        action = chance.randrange(4)
        if action == 0:
            event.pop(name, None)
        elif action == 1:
            event[chance.choice(KEYS)] = chance.choice(VALUES)
        else:
            event[name] = chance.choice(VALUES)
    fields = list(event.items())
    if chance.random() < 0.3:
        chance.shuffle(fields)
    if chance.random() < 0.03 and fields:
        text = json.dumps(dict(fields))[:-1] + f', "{fields[0][0]}": 1}}'
    else:
        text = json.dumps(dict(fields), ensure_ascii=chance.random() < 0.5)
    if chance.random() < 0.1:
        text = text[: chance.randrange(len(text) + 1)]
    if chance.random() < 0.2:
        text = chance.choice(HEADS) + text + chance.choice(TAILS)
    return text


def test_strict_gate_by_the_book(spark):
    chance = random.Random(20240301)
    texts = [message(chance) for _ in range(MESSAGES)]
    judged = gate.strict_gate(bronze(spark, texts)).select("offset", "reasons", "is_bad")
    found = {row.offset: row for row in judged.collect()}
    expected = [judge(text) for text in texts]
    wrong = [
        (text, found[offset].reasons, expected[offset])
        for offset, text in enumerate(texts)
        if found[offset].reasons != expected[offset]
    ]
    assert not wrong, f"{len(wrong)} differ, first: {wrong[0]}"
    passed = sum(not reasons for reasons in expected)
    assert MESSAGES * 0.1 < passed < MESSAGES * 0.9
    assert all(row.is_bad is bool(row.reasons) for row in found.values())
