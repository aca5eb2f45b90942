"""The event contract as column expressions.

``from_json`` cannot tell ``12.5`` from ``"12.5"``, so types are read from a
variant. A message is judged in two steps:

1. ``is_plain``: one comparison of the document's whole schema text (which keys,
   which JSON types) plus the value rules. Nearly every message ends here.
2. ``reasons``: all rules one by one, each broken rule giving a reason code. It
   alone decides; step 1 only answers early for messages with nothing to explain.
   Its parts sit in CASE branches, so plain rows never evaluate them.

Each part is a column of its own that the next one reads (``operators.gate`` adds them
in order). That way a value many rules use is computed once, and the long list of
rules stays out of higher-order functions, whose arguments Spark interprets. The
rules share a select with ``extra_keys``, which has such a function: Spark then
compiles that select by itself, in pieces small enough for the JVM to optimise.

The rules are compiled to SQL expression text and parsed once, which is far quicker
than building some three hundred small expressions one call at a time.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygate.functions.event_model import CONTRACT, EVENT_FIELDS, FieldRule

Rules = tuple[FieldRule, ...]

# --- Reason codes: two whole codes, and the families that name a field -----
MALFORMED = "MALFORMED_JSON"
ROOT_TYPE = "ROOT_TYPE"
MISSING = "MISSING"
TYPE = "TYPE"
PATTERN = "PATTERN"
ENUM = "ENUM"
FORMAT = "FORMAT"
RANGE = "RANGE"
EXTRA = "EXTRA"
COND = "COND"

# RFC 3339 date-time; the day of the month is checked against the calendar too.
DATE_TIME = (
    r"\A[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    r"[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)(\.[0-9]+)?"
    r"([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])\z"
)


def document() -> Column:
    """``raw_value`` as a one-element variant array, null when it does not parse.

    Wrapped, because a bare parse stops after the first value and would accept
    trailing text.
    """
    return F.expr("try_parse_json(concat('[', raw_value, ']'))")


# Nothing follows the first value. Text such as {...}]x closes the wrapping array
# early. Only a message with a ] in it can, so only those are parsed again, inside an
# object; no text can close both wrappings early.
NOTHING_FOLLOWS = """(
  try_variant_get(doc, '$[1]', 'variant') IS NULL
  AND (NOT contains(raw_value, ']')
       OR try_parse_json(concat('{"value":', raw_value, '}')) IS NOT NULL)
)"""
ONE_VALUE = f"""(
  doc IS NOT NULL AND try_variant_get(doc, '$[0]', 'variant') IS NOT NULL AND {NOTHING_FOLLOWS}
)"""


def _quoted(texts) -> str:
    return ", ".join(f"'{text}'" for text in texts)


def _get(field: str, as_type: str) -> str:
    return f"try_variant_get(doc, '$[0].{field}', '{as_type}')"


def _value_rules(rule: FieldRule, value: str) -> dict[str, str]:
    """Rules on a field's value by reason family; true or null means it holds."""
    rules = {}
    if rule.pattern:
        rules[PATTERN] = f"{value} RLIKE r'{rule.pattern}'"
    if rule.allowed:
        rules[ENUM] = f"{value} IN ({_quoted(rule.allowed)})"
    if rule.date_time:
        on_calendar = f"try_cast(substring({value}, 1, 10) AS date) IS NOT NULL"
        rules[FORMAT] = f"({value} RLIKE r'{DATE_TIME}' AND {on_calendar})"
    bounds = []
    if rule.minimum is not None:
        bounds.append(f"{value} >= {rule.minimum}")
    if rule.maximum is not None:
        bounds.append(f"{value} <= {rule.maximum}")
    if bounds:
        rules[RANGE] = f"({' AND '.join(bounds)})"
    return rules


def plain_signatures(rules: Rules = CONTRACT) -> list[str]:
    """Schema texts of a document that has all it must, and nothing else.

    One for each way the optional or nullable fields may appear.
    """
    forms = []
    for rule in sorted(rules, key=lambda rule: rule.name):
        kinds = ["STRING" if rule.kind == "string" else "BIGINT"]
        if rule.nullable:
            kinds.append("VOID")
        shown = [f"{rule.name}: {kind}" for kind in kinds]
        forms.append(shown if rule.required else [*shown, None])
    return [f"ARRAY<OBJECT<{', '.join(filter(None, choice))}>>" for choice in product(*forms)]


def is_plain(conditional: bool = False, rules: Rules = CONTRACT) -> Column:
    """True for a message that plainly keeps every rule; false or null if it needs a look.

    Needs ``raw_value``, ``doc`` and the flattened event columns, which hold the document's
    own values once the schema text matches. Only a whole number beyond 32 bits is null
    there, and is then taken from the document.
    """
    checks = [f"schema_of_variant(doc) IN ({_quoted(plain_signatures(rules))})", NOTHING_FOLLOWS]
    for rule in rules:
        value = rule.name
        if rule.name not in EVENT_FIELDS:
            value = _get(rule.name, "string" if rule.kind == "string" else "bigint")
        elif rule.kind == "integer":
            value = f"coalesce({rule.name}, {_get(rule.name, 'bigint')})"
        for holds in _value_rules(rule, value).values():
            checks.append(f"coalesce({holds}, true)" if rule.nullable else holds)
    if conditional:
        checks.append("(status = 'failed') = (failure_reason IS NOT NULL)")
    return F.expr(" AND ".join(checks))


def whole_numbers() -> dict[str, Column]:
    """The integer fields by value, however spelled (95.0, 9e1): for messages that passed."""
    return {
        rule.name: F.expr(f"coalesce({rule.name}, {_get(rule.name, 'bigint')})")
        for rule in CONTRACT
        if rule.kind == "integer"
    }


def _type_holds(rule: FieldRule, kinds: str) -> str:
    kind = f"{kinds}.{rule.name}"
    if rule.kind == "string":
        holds = f"{kind} = 'STRING'"
    else:
        # 80.0 and 1e2 are integers too: judged by value, not by spelling.
        number = _get(rule.name, "double")
        holds = (
            f"({kind} = 'BIGINT' OR {kind} RLIKE r'\\ADECIMAL\\([0-9]+,0\\)\\z' "
            f"OR ({kind} = 'DOUBLE' AND {number} % 1 = 0))"
        )
    return f"({holds} OR {kind} = 'VOID')" if rule.nullable else holds


def _rule_codes(conditional: bool, rules: Rules, kinds: str) -> list[str]:
    """Per rule, an expression that gives its reason code where the rule is broken."""
    missing, types, values = [], [], []
    for rule in rules:
        kind = f"{kinds}.{rule.name}"
        holds = _type_holds(rule, kinds)
        if rule.required:
            missing.append((f"{MISSING}:{rule.name}", f"{kind} IS NULL"))
        types.append((f"{TYPE}:{rule.name}", f"{kind} IS NOT NULL AND NOT ({holds})"))
        value = _get(rule.name, "string" if rule.kind == "string" else "double")
        for family, value_holds in _value_rules(rule, value).items():
            # A value is judged only where its type is right.
            values.append((f"{family}:{rule.name}", f"({holds}) AND NOT ({value_holds})"))
    if conditional:
        given = f"coalesce({kinds}.failure_reason, 'VOID')"
        judged = f"{kinds}.status = 'STRING' AND {given} IN ('STRING', 'VOID')"
        agrees = f"({_get('status', 'string')} = 'failed') = ({given} = 'STRING')"
        values.append((f"{COND}:failure_reason", f"{judged} AND NOT ({agrees})"))
    return [f"CASE WHEN {when} THEN '{code}' END" for code, when in missing + types + values]


def kinds(rules: Rules = CONTRACT, where: str = "true") -> Column:
    """JSON type name of each field, null where the key is absent; null for plain rows, and
    where the contract is not the row's (``where``)."""
    fields = ", ".join(
        f"'{rule.name}', schema_of_variant({_get(rule.name, 'variant')})" for rule in rules
    )
    needed = f"{where} AND NOT coalesce(plain, false)"
    return F.expr(f"CASE WHEN {needed} THEN named_struct({fields}) END")


def broken_rules(
    conditional: bool = False, rules: Rules = CONTRACT, kinds: str = "kinds"
) -> Column:
    """One entry per rule, the reason code where it is broken and null where it holds.

    Needs ``raw_value``, ``doc``, ``plain`` and ``kinds``; null for plain rows.
    """
    return F.expr(f"""CASE
        WHEN plain THEN NULL
        WHEN NOT coalesce({ONE_VALUE}, false) THEN array('{MALFORMED}')
        WHEN NOT startswith(schema_of_variant(doc), 'ARRAY<OBJECT<') THEN array('{ROOT_TYPE}')
        ELSE array({", ".join(_rule_codes(conditional, rules, kinds))}) END""")


def extra_keys(rules: Rules = CONTRACT) -> Column:
    """A reason code for each key the contract does not know, sorted; null for plain rows."""
    names = _quoted(rule.name for rule in rules)
    unknown = f"array_except(json_object_keys(raw_value), array({names}))"
    return F.expr(f"""CASE WHEN NOT coalesce(plain, false)
        THEN transform(sort_array({unknown}), key -> concat('{EXTRA}:', key)) END""")


def version(known: list[int]) -> Column:
    """The contract that judges a message: that of its own version, or the first one where the
    message names none of the known. Only a number names a version."""
    written = _get("schema_version", "variant")
    number = f"CASE WHEN schema_of_variant({written}) <> 'STRING' THEN " + _get(
        "schema_version", "double"
    ) + " END"
    listed = ", ".join(map(str, known))
    return F.expr(f"CASE WHEN {number} IN ({listed}) THEN int({number}) ELSE {known[0]} END")


def reasons() -> Column:
    """All the reasons a message breaks the contract, in a fixed order; empty if none.

    Needs ``broken`` (broken_rules) and ``extra`` (extra_keys).
    """
    return F.expr(f"""CASE
        WHEN broken IS NULL THEN cast(array() AS array<string>)
        WHEN broken[0] IN ('{MALFORMED}', '{ROOT_TYPE}') THEN broken
        ELSE concat(array_compact(broken), extra) END""")
