"""Counts, shapes and metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from gazette.functions.dates import utc_day
from gazette.schemas import (
    EXTRACTION_ERRORS, METRIC_NAMESPACE, PROCESSED_ARTICLES, UNIT_COUNT,
)


def objects_per_day(listing: DataFrame, ts: str = "LastModified") -> DataFrame:
    """Objects stored on each UTC day, oldest first."""
    return listing.groupBy(utc_day(F.col(ts)).alias("date")).agg(F.count(F.lit(1)).alias("objects")).orderBy("date")


def processed_per_feed(articles: DataFrame) -> DataFrame:
    """Articles of each feed (A5)."""
    return articles.groupBy("rss").agg(F.count(F.lit(1)).alias("processed"))


def failed(title: Column, content: Column) -> Column:
    """An extraction that gave neither title nor text."""
    return title.isNull() & content.isNull()


def errors_per_feed(articles: DataFrame) -> DataFrame:
    """Failed extractions of each feed."""
    return articles.groupBy("rss").agg(
        F.count_if(failed(F.col("title"), F.col("content"))).alias("errors")
    )


def outcomes(articles: DataFrame) -> DataFrame:
    """Per article: one processed, and one failure or none."""
    return articles.select(
        "rss", F.lit(1).alias("processed"),
        failed(F.col("title"), F.col("content")).cast("int").alias("errors"),
    )


def feed_metrics(outcomes: DataFrame, ts: Column) -> DataFrame:
    """`ProcessedArticles` and `ExtractionErrors` of each feed as metric rows.

    `outcomes` has `rss`, `processed`, `errors`; `feed` says whose the numbers are.
    """
    sums = outcomes.groupBy("rss").agg(F.sum("processed").alias("processed"), F.sum("errors").alias("errors"))
    data = F.array(*[
        F.struct(F.lit(name).alias("metric_name"), F.col(value).cast("double").alias("value"))
        for name, value in ((PROCESSED_ARTICLES, "processed"), (EXTRACTION_ERRORS, "errors"))
    ])
    return sums.select(F.col("rss").alias("feed"), F.inline(data)).select(
        F.lit(METRIC_NAMESPACE).alias("namespace"), "metric_name", "value",
        F.lit(UNIT_COUNT).alias("unit"), ts.alias("ts"), "feed",
    )


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Data points, sum, mean and maximum of each metric."""
    return metrics.groupBy("namespace", "metric_name", "unit").agg(
        F.count(F.lit(1)).alias("points"),
        F.sum("value").alias("total"), F.avg("value").alias("mean"), F.max("value").alias("largest"),
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written (A4, A8): read `.get["rows"]` after."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """The first `n` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def sample(df: DataFrame, key: str, n: int = 20, seed: int = 0) -> DataFrame:
    """`n` rows picked by a hash of key and seed, the same ones every time (T4)."""
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    return df.orderBy(order, F.col(key)).limit(n)


def annotation_cost(articles: DataFrame, price: float, text: str = "content", chars_per_token: int = 4) -> DataFrame:
    """Tokens and price of annotating each feed's articles: `rss`, `articles`, `tokens`, `cost`.

    `price` is that of a thousand tokens; a null text costs nothing.
    """
    tokens = F.ceil(F.coalesce(F.length(text), F.lit(0)) / chars_per_token)
    return articles.groupBy("rss").agg(
        F.count(F.lit(1)).alias("articles"), F.sum(tokens).alias("tokens"),
    ).withColumn("cost", F.col("tokens") * F.lit(price / 1000))
