"""Stored articles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.functions.bodies import object_metadata
from gazette.functions.dates import object_path
from gazette.operators.filters import in_day_partitions, in_range, split_keyed
from gazette.operators.incremental import latest_per_key
from gazette.schemas import STORED
from gazette.sinks.bucketed import Bucketed, read_bucketed, write_bucketed
from gazette.sinks.commits import only_committed


def storage_rows(articles: DataFrame, ingest_ts: dt.datetime) -> DataFrame:
    """Articles as stored: with metadata, object path, ingest time and day."""
    ts = F.lit(ingest_ts).cast("timestamp")
    return articles.select(
        "*",
        object_metadata().alias("metadata"),
        object_path(ts, F.col("article_id")).alias("path"),
        ts.alias("ingest_ts"),
        F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"),
    )


def article_table(path: str, buckets: int) -> Bucketed:
    """The store as a table bucketed by article."""
    return Bucketed(path, STORED, "article_id", buckets, ("year", "month", "day", "batch_id"))


def save_articles(
    articles: DataFrame, path: str, ingest_ts: dt.datetime, batch_id: int = 0, file_format: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Store the articles that have an id, under `year/month/day/batch_id` (K6).

    A batch written again replaces its own folder. Articles must be unique by
    `article_id` within the batch. With `buckets` (the same for all of a store) later
    reads do not move the articles.
    """
    kept, _ = split_keyed(articles)
    rows = storage_rows(kept, ingest_ts).withColumn("batch_id", F.lit(batch_id).cast("long"))
    if buckets:
        write_bucketed(rows, article_table(path, buckets))
        return
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day", "batch_id")
        .format(file_format)
        .save(path)
    )


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What one batch stored; no other folder is read."""
    return spark.read.schema(STORED).parquet(path).filter(F.col("batch_id") == batch_id)


def read_articles(
    spark: SparkSession,
    path: str,
    start_date: str | None = None,
    end_date: str | None = None,
    whole_end_day: bool = False,
    file_format: str = "parquet",
    commits: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Stored articles of a range of ingest times, the last write of each object.

    Only folders the range can touch are read, and with `commits` only committed batches.
    """
    rows = (
        read_bucketed(spark, article_table(path, buckets)) if buckets
        else spark.read.schema(STORED).format(file_format).load(path))
    rows = in_day_partitions(rows, start_date, end_date)
    if commits:
        rows = only_committed(rows, commits)
    rows = in_range(rows, "ingest_ts", start_date, end_date, whole_end_day)
    return latest_per_key(
        rows, ["year", "month", "day", "article_id"], [F.desc("ingest_ts"), F.desc("batch_id")]
    )
