"""Incremental reading and last-write-wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gazette.operators.joins import lookup

# Fixed value: how often a message is received before it is a dead letter.
MAX_RECEIVE = 3


def new_entries(entries: DataFrame, registry: DataFrame) -> DataFrame:
    """Entries published after the stored cursor of their feed.

    The comparison is strict and with the stored cursor, so entries of one fetch
    pass in any order, and one that carries the cursor's own second does not.
    """
    cursors = registry.select(F.col("url").alias("rss"), "dt")
    return lookup(entries, cursors, "rss").filter(newer_than_cursor()).drop("dt")


def newer_than_cursor() -> Column:
    """The strict test of F3 on `unixTime` and `dt`; a feed without a cursor takes all."""
    return F.col("unixTime") > F.coalesce("dt", F.lit(0))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row written last for each key (W1); `order` puts it first.

    Each task keeps one row per key before the shuffle, so a crowded key costs
    no more than the number of tasks.
    """
    return first_per_key(df, keys, order, 1)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of each key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def capped_per_feed(articles: DataFrame, limit: int | None = None) -> DataFrame:
    """At most `limit` newest articles per feed (W2); without a limit nothing is cut."""
    if limit is None:
        return articles
    return first_per_key(articles, ["rss"], [F.desc("unixTime"), F.asc("article_id")], limit)


def split_dead_letters(
    messages: DataFrame, max_receive: int = MAX_RECEIVE, attempts: str = "attempts"
) -> tuple[DataFrame, DataFrame]:
    """Messages to deliver again, and those received `max_receive` times."""
    dead = F.coalesce(F.col(attempts), F.lit(0)) >= max_receive
    return messages.filter(~dead), messages.filter(dead)


def deduplicated_stream(articles: DataFrame, event_time: str, delay: str) -> DataFrame:
    """A stream of articles without redelivered copies (X8); state lasts for `delay`."""
    return articles.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["article_id"])
