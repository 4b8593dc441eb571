"""The stored feed registry.

It is a table of cursor rows, one folder per write. A cursor never moves back, so
the current state is the largest `dt` of each feed: rows are only added, a write
repeated after a crash changes nothing, and no reader sees a half-made table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.operators.counts import counted
from gazette.operators.registry import new_feeds
from gazette.sources.files import none_if_missing

# Folder number of seeded feeds; stream batches count from 0.
SEED = -1


def read_registry(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """Every feed with its cursor (S2), or as it was before a batch wrote its own."""
    log = none_if_missing(
        lambda: spark.read.schema("url string, dt bigint, batch_id bigint").parquet(path)
    )
    if log is None:
        log = spark.createDataFrame([], "url string, dt bigint, batch_id bigint")
    if before_batch is not None:
        log = log.filter(F.col("batch_id") < before_batch)
    return log.groupBy("url").agg(F.max("dt").alias("dt"))


def write_cursors(updates: DataFrame, path: str, batch_id: int) -> None:
    """Cursors of one batch (K2); the same batch written again replaces itself."""
    updates.select("url", "dt").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def seed_registry(feed_list: DataFrame, path: str) -> int:
    """Insert the listed feeds that are not there yet (K1) and tell how many."""
    registry = read_registry(feed_list.sparkSession, path)
    rows, observed = counted(new_feeds(feed_list, registry), "seeded")
    rows.write.mode("append").parquet(f"{path}/batch_id={SEED}")
    return observed.get["rows"]


def compact_registry(spark: SparkSession, path: str, new_path: str, batch_id: int) -> None:
    """The state before `batch_id` as one folder of a new table."""
    state = read_registry(spark, path, before_batch=batch_id)
    state.write.mode("errorifexists").parquet(f"{new_path}/batch_id={batch_id - 1}")
