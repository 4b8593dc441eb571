"""Cursors kept as the state of a stream, one per feed."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Tasks get this module's classes with the plan: they need not import the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CURSOR = "url string, dt bigint, entries bigint, stalled boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CursorProcessor(StatefulProcessor):
    """The cursor of a feed, moved by each batch to its newest entry and never back.

    An entry counts if it is newer than the cursor was before the batch, so entries of a
    batch count in any order and one that comes late does not. With `stalled_ms`, a timer
    that every batch with entries sets anew reports a feed that has been silent.
    """

    def __init__(self, stalled_ms: int | None):
        self.stalled_ms = stalled_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", "dt bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.cursor.update((int(initialState["dt"].iloc[0]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.cursor.get()[0] if self.cursor.exists() else None
        newest, counted = before, 0
        for some in rows:
            times = some["unixTime"].dropna()
            if before is not None:
                times = times[times > before]
            if len(times):
                counted += len(times)
                newest = int(times.max()) if newest is None else max(newest, int(times.max()))
        if counted:
            self.cursor.update((newest,))
            if self.stalled_ms:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stalled_ms)
            yield pd.DataFrame({"url": [key[0]], "dt": [newest], "entries": [counted], "stalled": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"url": [key[0]], "dt": [self.cursor.get()[0]], "entries": [0], "stalled": [True]})

    def close(self) -> None:
        """Nothing is held beside the state."""


def use_state_store(spark: SparkSession) -> None:
    """Keep state in RocksDB, which processors of this kind need."""
    spark.conf.set(PROVIDER, ROCKSDB)


def cursor_stream(entries: DataFrame, registry: DataFrame | None = None, stalled_ms: int | None = None) -> DataFrame:
    """Moved cursors of a stream of entries (`rss`, `unixTime`): `url`, `dt`, `entries`, `stalled`.

    A row comes out for each feed and batch that moved its cursor (update mode). The state
    is one number a feed, whatever the number of entries, and survives a restart from
    the stream's checkpoint; `registry` (`url`, `dt`) is where it begins. With `stalled_ms` a
    feed that has had no entry for so long comes out once with `stalled`: that asks for a
    trigger that goes on, since timers of the wall clock keep a run of `availableNow` going.
    """
    use_state_store(entries.sparkSession)
    start = None
    if registry is not None:
        start = registry.filter("url IS NOT NULL AND dt IS NOT NULL").select("url", "dt").groupBy("url")
    return entries.selectExpr("rss AS url", "unixTime").filter("url IS NOT NULL").groupBy("url").transformWithStateInPandas(
        CursorProcessor(stalled_ms), CURSOR, "Update", "ProcessingTime" if stalled_ms else "None", start)
