"""Batches as they begin and as they are committed.

A batch records its instant before it writes anything, so that one done again, a
day later even, puts its rows where they were. It is committed after its last
write; readers that ask for committed batches do not see half of one. Both are
single rows in folders of their own, written whole or not at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.sources.files import none_if_missing

_BEGUN = "instant timestamp, day string"
_COMMITTED = "rows_stored bigint"


def begin_batch(spark: SparkSession, path: str, batch_id: int, now: dt.datetime) -> dt.datetime:
    """The instant of a batch: `now`, or what was recorded when it was first begun."""
    folder = f"{path}/begun/batch_id={batch_id}"
    known = none_if_missing(lambda: spark.read.schema(_BEGUN).parquet(folder))
    rows = [] if known is None else known.select(F.unix_micros("instant").alias("us")).collect()
    if not rows:
        # a folder without a row is a beginning that did not end
        spark.createDataFrame([(int(now.timestamp() * 1_000_000),)], "us bigint").select(
            F.timestamp_micros("us").alias("instant"),
            F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd").alias("day"),
        ).coalesce(1).write.mode("overwrite").parquet(folder)
        return now
    return dt.datetime.fromtimestamp(rows[0]["us"] / 1_000_000, dt.timezone.utc)


def commit_batch(spark: SparkSession, path: str, batch_id: int, rows_stored: int) -> None:
    """Declare a batch whole; done again it says the same."""
    spark.createDataFrame([(rows_stored,)], _COMMITTED).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/committed/batch_id={batch_id}"
    )


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """`batch_id`, `instant`, `day`, `rows_stored` of every committed batch."""
    begun, done = (
        none_if_missing(lambda f=folder, s=schema: spark.read.schema(f"{s}, batch_id bigint").parquet(f"{path}/{f}"))
        for folder, schema in (("begun", _BEGUN), ("committed", _COMMITTED))
    )
    if begun is None or done is None:
        return spark.createDataFrame([], f"batch_id bigint, {_BEGUN}, {_COMMITTED}")
    return begun.join(done, "batch_id").select("batch_id", "instant", "day", "rows_stored")


def only_committed(rows: DataFrame, path: str) -> DataFrame:
    """Rows whose `batch_id` is committed: one row a batch decides, folders of others are not read."""
    return rows.join(committed_batches(rows.sparkSession, path).select("batch_id"), "batch_id", "left_semi")
