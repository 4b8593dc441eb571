"""Copies of articles and feeds that mostly fail."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gazette.functions.text import key_of


def exact_copies(articles: DataFrame, key: str, text: str) -> DataFrame:
    """`key`, the smallest key with the same text (`first_key`) and how many have it (`copies`).

    Texts are counted by their hash, so none is shuffled, and counts combine first.
    A row without a text is its own only copy.
    """
    hashed = articles.select(F.col(key), F.coalesce(key_of(F.col(text), 64), F.concat(F.lit("none "), F.col(key))).alias("_hash"))
    first = hashed.groupBy("_hash").agg(F.min(key).alias("first_key"), F.count(F.lit(1)).alias("copies"))
    return hashed.join(first, "_hash").select(key, "first_key", "copies")


def error_rates(outcomes: DataFrame, feed: str, failed: str) -> DataFrame:
    """Share of failed outcomes of every feed."""
    return outcomes.groupBy(feed).agg(F.avg(F.col(failed).cast("int")).alias("error_rate"))


def reliable_feeds(feeds: DataFrame, rates: DataFrame, feed: str, most: float) -> DataFrame:
    """Feeds whose error rate is at most `most`, those never tried among them."""
    return feeds.join(rates.where(F.col("error_rate") > most), feed, "left_anti")
