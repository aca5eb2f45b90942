"""Typed views of the text columns an event carries.

Every cast is a ``try_`` cast: text that does not convert gives null instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygate.functions.event_model import HIGH_RISK_SCORE

# 36 whole digits and cents, the most that Spark's exact numbers hold. Sums have the same
# type, so adding money up is exact and does not depend on row order.
MONEY = "decimal(38,2)"

# RFC 3339 date-time in parts: day, hour and minute, second, fraction, zone.
_PARTS = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[Tt]([0-9]{2}:[0-9]{2}):([0-9]{2})([.][0-9]+)?"
    r"([Zz]|[+-][0-9]{2}:[0-9]{2})$"
)


def money(amount: Column) -> Column:
    """Amount text as an exact decimal, null when it is not a plain number."""
    return amount.try_cast(MONEY)


def approximate_money(amount: Column) -> Column:
    """Amount text as a double; also takes what only a double can hold (NaN, 1e300)."""
    return amount.try_cast("double")


def written_date(event_time: Column) -> Column:
    """The calendar date as written in the text, whatever offset follows it.

    RFC 3339 allows a small t, which the cast does not read.
    """
    day = F.when(event_time.rlike(_PARTS), F.substring(event_time, 1, 10).try_cast("date"))
    return F.coalesce(event_time.try_cast("date"), day)


def utc_date(event_time: Column) -> Column:
    """The UTC calendar date of the instant (the session time zone must be UTC)."""
    return F.to_date(instant(event_time))


def instant(event_time: Column) -> Column:
    """The point in time the text names.

    Only texts that Spark does not read are taken apart: small t and z, a leap second
    (the second after :59), offsets of up to 23:59.
    """
    return F.coalesce(F.try_to_timestamp(event_time), _from_parts(event_time))


def _from_parts(event_time: Column) -> Column:
    def part(group: int) -> Column:
        return F.regexp_extract(event_time, _PARTS, group)

    leap = part(3) == "60"
    second = F.when(leap, "59").otherwise(part(3))
    local = F.concat(part(1), F.lit("T"), part(2), F.lit(":"), second, part(4), F.lit("Z"))
    zone = part(5)
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    offset = sign * (
        F.coalesce(F.substring(zone, 2, 2).try_cast("int"), F.lit(0)) * 3600
        + F.coalesce(F.substring(zone, 5, 2).try_cast("int"), F.lit(0)) * 60
    )
    shift = F.when(leap, 1).otherwise(0) - offset
    return F.when(
        event_time.rlike(_PARTS), F.try_to_timestamp(local) + F.make_dt_interval(secs=shift)
    )


def high_risk(risk_score: Column) -> Column:
    """1 for a score at or above the threshold, otherwise (and for null) 0."""
    return F.when(risk_score >= HIGH_RISK_SCORE, 1).otherwise(0)


def stamp(as_of: Column | None) -> Column:
    """Audit time: the caller's, or the time the query starts."""
    return F.current_timestamp() if as_of is None else as_of
