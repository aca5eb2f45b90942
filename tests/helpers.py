"""Small things several test files need."""

from __future__ import annotations

import contextlib
import io

from tallygate.simulation import fixture

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    """The physical plan as ``explain`` shows it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def small_bronze(spark, payload="simulated"):
    return fixture.bronze_from_events(fixture.event_table(spark, SF_DIR), payload)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)
