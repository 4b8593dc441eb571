"""Feed registry: seeding, cursors, messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gazette.functions.bodies import decoded, message_body
from gazette.functions.dates import whole_seconds
from gazette.operators.joins import lookup


def new_feeds(feed_list: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed feeds the registry does not know, each once and with cursor 0."""
    listed = feed_list.select(F.col("u").alias("url")).filter("url != ''").distinct()
    return listed.join(registry.select("url"), "url", "left_anti").withColumn("dt", F.lit(0).cast("long"))


def known_feeds(feed_list: DataFrame, registry: DataFrame) -> DataFrame:
    """Listed feeds the registry already has."""
    return lookup(feed_list, registry.select(F.col("url").alias("u")), "u", "left_semi")


def seed_counts(feed_list: DataFrame, registry: DataFrame) -> DataFrame:
    """`new_items` and `existing_items` of a seeding (A3).

    A feed listed again counts as existing from its second occurrence on. The
    list is reduced to one row per feed before it meets the registry.
    """
    listed = feed_list.filter("u != ''").groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    known = registry.select(F.col("url").alias("u")).distinct().withColumn("known", F.lit(True))
    new = F.coalesce(F.sum(F.when(F.col("known").isNull(), 1)), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return listed.join(known, "u", "left").agg(
        new.alias("new_items"), (total - new).alias("existing_items")
    )


def feed_messages(registry: DataFrame) -> DataFrame:
    """One JSON message `value` per feed that has an url."""
    return registry.filter("url IS NOT NULL AND url != ''").select(
        message_body(F.col("url"), whole_seconds(F.col("dt"))).alias("value")
    )


def decoded_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages as `u`, `dt`, and rejects that are no message."""
    read = messages.withColumn("m", decoded(F.col("value")))
    return (
        read.filter("m.u IS NOT NULL").select("m.*"),
        read.filter("m.u IS NULL").select("value"),
    )


def max_per_feed(entries: DataFrame) -> DataFrame:
    """Newest publish time of each feed: `url`, `dt` (A1); combined before the shuffle."""
    return entries.groupBy(F.col("rss").alias("url")).agg(F.max("unixTime").alias("dt"))


def advanced_cursors(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """The registry with every cursor moved to its newest entry (A1).

    Feeds without an entry keep their cursor; entries of unknown feeds add nothing.
    """
    newest = max_per_feed(entries).withColumnRenamed("dt", "newest")
    return registry.join(newest, "url", "left").select("url", F.greatest("dt", "newest").alias("dt"))


def upserted_cursors(registry: DataFrame, updates: DataFrame) -> DataFrame:
    """The registry after a write of cursors: new feeds added, no cursor moved back."""
    latest = updates.groupBy("url").agg(F.max("dt").alias("new_dt"))
    return registry.join(latest, "url", "full_outer").select(
        "url", F.greatest("dt", "new_dt").alias("dt")
    )
