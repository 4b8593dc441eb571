"""Continuous ingestion of feed messages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gazette.operators.incremental import MAX_RECEIVE
from gazette.plans.ingest import Stores, check_strategy, ingest_batch

# Fixed value: how often feeds are read.
INTERVAL = "240 minutes"


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New message files of a folder as a stream of `value`."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def _now(batch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_ingest(
    messages: DataFrame, docs: DataFrame, pages: DataFrame, stores: Stores, checkpoint: str,
    strategy: str = "s3", clean: bool = False, model=None,
    clock: Callable[[int], dt.datetime] = _now, once: bool = False, interval: str = INTERVAL,
    max_receive: int = MAX_RECEIVE, after: Callable[[str], None] = lambda step: None,
) -> StreamingQuery:
    """Start ingesting a stream of messages, every `interval` or `once` for what is there.

    Each micro-batch is one `ingest_batch`. It is acknowledged by the stream's
    checkpoint after its articles and cursors are written; a batch that failed is
    run again with the same number and overwrites what it had written.
    """
    check_strategy(strategy)

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, docs, pages, stores, batch_id, clock(batch_id), strategy, clean, model, max_receive, after)

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        messages.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
