"""Feed messages as text files (K3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gazette.operators.counts import counted
from gazette.operators.registry import feed_messages


def send_messages(registry: DataFrame, path: str) -> int:
    """Add one message per feed to a folder a stream reads; returns the number sent."""
    messages, observed = counted(feed_messages(registry), "sent")
    messages.write.mode("append").text(path)
    return observed.get["rows"]
