"""A contract out of the text it is published as: the part of JSON Schema (draft 7) for one flat
object.

Every word of the text is either understood or refused: a rule that was skipped would let
messages through that the contract forbids.
"""

from __future__ import annotations

import json

from tallygate.functions.event_model import FieldRule

# --- Fixed values: words of draft 7 that are understood, and those that say nothing to a gate ---
_SAYS_NOTHING = {"$schema", "$id", "$comment", "title", "description", "examples", "default"}
_OF_OBJECTS = {"type", "required", "properties", "additionalProperties"} | _SAYS_NOTHING
_OF_TEXTS = {"type", "pattern", "enum", "format"} | _SAYS_NOTHING
_OF_INTEGERS = {"type", "minimum", "maximum"} | _SAYS_NOTHING


def _refuse(given: dict, known: set[str], where: str) -> None:
    unknown = sorted(given.keys() - known)
    if unknown:
        raise ValueError(f"{where}: {', '.join(unknown)} is not understood")


def _whole(pattern: str, where: str) -> str:
    """A pattern for a whole text, where ^ and $ are not also ends of lines."""
    if not (pattern.startswith("^") and pattern.endswith("$")) or pattern.endswith(r"\$"):
        raise ValueError(f"{where}: only patterns from ^ to $ are understood")
    if "'" in pattern:
        raise ValueError(f"{where}: a pattern with a quote is not understood")
    return rf"\A{pattern[1:-1]}\z"


def compiled(text: str) -> tuple[FieldRule, ...]:
    """The rules of a contract, field by field in the text's order."""
    schema = json.loads(text)
    _refuse(schema, _OF_OBJECTS, "contract")
    if schema.get("type") != "object" or schema.get("additionalProperties") is not False:
        raise ValueError("contract: an object without additional properties is asked for")
    properties, required = schema.get("properties", {}), set(schema.get("required", ()))
    if required - properties.keys():
        raise ValueError(f"contract: {sorted(required - properties.keys())} has no property")
    return tuple(
        _field(name, said, name in required) for name, said in properties.items()
    )


def _field(name: str, said: dict, required: bool) -> FieldRule:
    if not name.isidentifier():
        raise ValueError(f"{name}: only plain names are understood")
    kinds = said.get("type")
    kinds = [kinds] if isinstance(kinds, str) else list(kinds or ())
    nullable = "null" in kinds
    kind = [k for k in kinds if k != "null"]
    if kind not in (["string"], ["integer"]):
        raise ValueError(f"{name}: type {said.get('type')!r} is not understood")
    if kind == ["integer"]:
        _refuse(said, _OF_INTEGERS, name)
        return FieldRule(
            name, "integer", required, nullable,
            minimum=said.get("minimum"), maximum=said.get("maximum"),
        )
    _refuse(said, _OF_TEXTS, name)
    allowed = tuple(said.get("enum", ()))
    if any(not isinstance(value, str) or "'" in value or "\\" in value for value in allowed):
        raise ValueError(f"{name}: only plain texts can be listed")
    if said.get("format", "date-time") != "date-time":
        raise ValueError(f"{name}: format {said['format']!r} is not understood")
    return FieldRule(
        name, "string", required, nullable,
        pattern=_whole(said["pattern"], name) if "pattern" in said else None,
        allowed=allowed,
        date_time="format" in said,
    )
