"""Messages to Bronze, as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallygate.sources.messages import envelope
from tallygate.sources.tables import append_stream


def land(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    until_drained: bool = False,
    ingested_at: Column | None = None,
) -> StreamingQuery:
    """Append every message to Bronze once, one folder per landing day. Map-only."""
    rows = envelope(messages, ingested_at)
    return append_stream(rows, path, checkpoint, until_drained, "ingest_date")
