"""Objects per day as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def daily_counts(listing: DataFrame, ts: str = "LastModified", delay: str | None = None) -> DataFrame:
    """Objects per UTC day of a stream.

    Without `delay` the result is for complete mode and equals the batch answer.
    With it the state is bounded: in append mode a day comes out once it is
    closed, and objects later than `delay` are left out.
    """
    df = listing.withColumn(ts, F.col(ts).cast("timestamp"))
    if delay:
        df = df.withWatermark(ts, delay)
    counts = df.groupBy(F.window(ts, "1 day")).agg(F.count(F.lit(1)).alias("objects"))
    return counts.select(F.to_date("window.start").alias("date"), "objects")
