"""Streams whose state is bounded, and the rows that came too late for it."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators left out as older than the watermark, over its last batches."""
    return sum(
        state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])
