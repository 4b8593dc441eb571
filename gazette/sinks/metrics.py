"""Metric rows of a run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from gazette.operators.counts import feed_metrics
from gazette.schemas import METRIC_NAMESPACE, PROCESSING_TIME, UNIT_SECONDS

_METRIC = (
    "namespace string, metric_name string, value double, unit string, ts timestamp, feed string"
)


def processing_time(spark: SparkSession, seconds: float, ts: dt.datetime) -> DataFrame:
    """Wall time of a run as one metric row."""
    return spark.createDataFrame(
        [(METRIC_NAMESPACE, PROCESSING_TIME, float(seconds), UNIT_SECONDS, ts, None)], _METRIC
    )


def write_metrics(
    outcomes: DataFrame, seconds: float, path: str, ts: dt.datetime, batch_id: int = 0
) -> None:
    """Counts per feed and the run's wall time (K14); one folder per batch."""
    counts = feed_metrics(outcomes, F.lit(ts).cast("timestamp"))
    rows = counts.unionByName(processing_time(outcomes.sparkSession, seconds, ts))
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_METRIC}, batch_id bigint").parquet(path)
