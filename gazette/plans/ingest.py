"""From feed documents to articles and cursors."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gazette.functions.bodies import decoded, object_metadata
from gazette.functions.dates import publish_epoch
from gazette.functions.text import cleaned, key_of
from gazette.operators.incremental import MAX_RECEIVE, latest_per_key, newer_than_cursor, split_dead_letters
from gazette.operators.joins import lookup, split_join
from gazette.operators.registry import decoded_messages, max_per_feed
from gazette.operators.vectors import embed, vector_records
from gazette.operators.counts import outcomes
from gazette.schemas import ARTICLE, ARTICLE_COLUMNS, STRATEGIES
from gazette.session import stored
from gazette.sinks.articles import read_batch, save_articles
from gazette.sinks.commits import begin_batch, commit_batch
from gazette.sinks.metrics import write_metrics
from gazette.sinks.registry import read_registry, write_cursors
from gazette.sinks.vectors import collection, upsert_vectors
from gazette.sources.feeds import parsed_feeds
from gazette.sources.pages import extract_articles
from gazette.sources.queue import return_messages


def feed_cursors(messages: DataFrame, registry: DataFrame) -> DataFrame:
    """`feed_url`, `dt` of each feed asked for, once, and `stored`, the registry's cursor.

    The cursor is the later one of message and registry, so a message that was
    delayed or delivered again reads nothing a second time.
    """
    asked = messages.groupBy(F.col("u").alias("url")).agg(F.min("dt").alias("asked"))
    return asked.join(registry, "url", "left").select(
        F.col("url").alias("feed_url"), F.greatest("asked", "dt").alias("dt"), F.col("dt").alias("stored")
    )


def moved_cursors(cursors: DataFrame, entries: DataFrame) -> DataFrame:
    """`url`, `dt`, `stored` of each feed asked for, the cursor at its newest entry (A1)."""
    newest = max_per_feed(entries).select(F.col("url").alias("feed_url"), F.col("dt").alias("newest"))
    return cursors.join(newest, "feed_url", "left").select(
        F.col("feed_url").alias("url"),
        F.coalesce(F.greatest("dt", "newest"), F.lit(0)).alias("dt"), "stored",
    )


def read_entries(cursors: DataFrame, docs: DataFrame, now_ts: int) -> DataFrame:
    """Entries newer than their feed's cursor, and unreadable documents.

    `rss`, `link`, `unixTime` of an entry; of a document that is not XML `rss`
    and its text in `broken`. The cursor meets the feed document, not each entry
    of it, and entries are filtered before any page is looked at.
    """
    asked = lookup(docs.select("feed_url", "xml"), cursors.select("feed_url", "dt"), "feed_url")
    # Dates are read inside the array: a filter on a column made after the
    # explode would be moved below it and read each of them twice.
    dated = F.transform("entries", lambda e: F.struct(
        e["link"].alias("link"), publish_epoch(e["published"], now_ts).alias("unixTime")
    ))
    return (
        parsed_feeds(asked)
        .select(F.col("feed_url").alias("rss"), "dt", "broken", F.explode_outer(dated).alias("e"))
        .select("rss", "dt", "broken", "e.*")
        .filter(F.col("broken").isNotNull() | newer_than_cursor())
        .select("rss", "link", "unixTime", "broken")
    )


def fresh_entries(cursors: DataFrame, docs: DataFrame, now_ts: int) -> DataFrame:
    """Only the entries of `read_entries`."""
    return read_entries(cursors, docs, now_ts).filter("unixTime IS NOT NULL").drop("broken")


def assembled(
    entries: DataFrame, pages: DataFrame, clean: bool = False, unique_links: bool = False
) -> DataFrame:
    """Articles of entries and fetched pages, an entry without a page included.

    Pages are first cut down to the links asked for and turned into title and
    text, so no html is shuffled where the links are few. Unless links are known
    to be unique, one that many entries share is kept out of the shuffle.
    """
    links = entries.select(F.col("link").alias("url")).distinct()
    found = extract_articles(lookup(pages.select("url", "html"), links, "url"))
    one = latest_per_key(found, ["url"], [F.asc("title"), F.asc("content")]).withColumnRenamed("url", "link")
    text = cleaned if clean else (lambda c: c)
    joined = entries.join(one, "link", "left") if unique_links else split_join(entries, one, "link", "left")
    return (
        joined.select(
            "link", "rss", text(F.col("title")).alias("title"), text(F.col("content")).alias("content"),
            "unixTime", key_of(F.col("rss")).alias("rss_id"), key_of(F.col("link")).alias("article_id"),
            F.lit(None).cast("string").alias("llm_summary"),
            F.lit(None).cast("array<float>").alias("embedding"),
        )
        .select(*ARTICLE_COLUMNS)
    )


def ingest_feeds(
    messages: DataFrame, registry: DataFrame, docs: DataFrame, pages: DataFrame, now_ts: int,
    clean: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Articles new to every feed asked for, and the feeds' cursors after them.

    The entries, a few short columns, are stored in the shared folder first: the
    feed documents are parsed once, whatever is asked of the two results.
    """
    cursors = feed_cursors(messages, registry)
    entries = stored(fresh_entries(cursors, docs, now_ts), "entries")
    moved = moved_cursors(cursors, entries).select("url", "dt")
    return assembled(entries, pages, clean), moved


def last_written() -> list[Column]:
    """Which entry stays when one article comes from several."""
    return [F.desc("unixTime"), F.asc("rss"), F.asc("link")]


@dataclass(frozen=True)
class Stores:
    """Where a run keeps its tables."""

    registry: str
    articles: str
    rejects: str
    metrics: str
    vectors: str | None = None
    namespace: str = "articles"
    # When given: batches begun and committed; a queue that gets failed messages back; those given up.
    commits: str | None = None
    queue: str | None = None
    dead: str | None = None


def check_strategy(strategy: str) -> list[str]:
    """Sinks of a storage strategy, in writing order (K5); an unknown one raises."""
    if strategy not in STRATEGIES:
        raise ValueError(f"invalid storage strategy {strategy!r}, expected one of {sorted(STRATEGIES)}")
    return STRATEGIES[strategy]


def save(articles: DataFrame, stores: Stores, strategy: str, now: dt.datetime, batch_id: int, model=None) -> None:
    """Write articles to the sinks of the strategy (K5).

    With more than one sink, or none that keeps the text, hand in a stored frame.
    """
    for sink in check_strategy(strategy):
        if sink == "articles":
            save_articles(articles, stores.articles, now, batch_id)
        else:
            dim = collection(articles.sparkSession, stores.vectors)["dim"]
            vectors = embed(articles, "content", dim, model)
            upsert_vectors(
                vector_records(vectors, stores.namespace, object_metadata()), stores.vectors, batch_id
            )


def rejects(messages: DataFrame, read: DataFrame) -> DataFrame:
    """What could not be used, as `kind`, `feed`, `body`: messages, documents, entries without a link."""
    text = F.lit(None).cast("string")
    broken = read.filter("broken IS NOT NULL")
    unlinked = read.filter("broken IS NULL AND coalesce(link, '') = ''")
    return (
        messages.select(F.lit("message").alias("kind"), text.alias("feed"), F.col("value").alias("body"))
        .unionByName(broken.select(F.lit("document").alias("kind"), F.col("rss").alias("feed"), F.col("broken").alias("body")))
        .unionByName(unlinked.select(F.lit("entry").alias("kind"), F.col("rss").alias("feed"), text.alias("body")))
    )


def batch_outcomes(entries: DataFrame, articles: DataFrame, broken: DataFrame) -> DataFrame:
    """Processed entries (those with a link), failed pages and unreadable documents, for `feed_metrics`."""
    none, one = F.lit(0).alias, F.lit(1).alias
    return (
        entries.select("rss", one("processed"), none("errors"))
        .unionByName(outcomes(articles).withColumn("processed", F.lit(0)))
        .unionByName(broken.select("rss", none("processed"), one("errors")))
    )


def failed_messages(messages: DataFrame, read: DataFrame) -> DataFrame:
    """Messages that are none, or whose feed has an unreadable document, with one attempt more."""
    broken = read.filter("broken IS NOT NULL").select(F.col("rss").alias("u")).distinct()
    asked = messages.withColumn("u", decoded(F.col("value"))["u"])
    failed = asked.join(broken, "u", "left_semi").unionByName(asked.filter("u IS NULL"))
    return failed.select("message_id", "value", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempts"))


def hand_back(messages: DataFrame, read: DataFrame, stores: Stores, batch_id: int, max_receive: int) -> None:
    """Failed messages back into the queue; those received `max_receive` times to the dead letters."""
    again, dead = split_dead_letters(failed_messages(messages, read), max_receive)
    dead.write.mode("overwrite").parquet(f"{stores.dead}/batch_id={batch_id}")
    return_messages(again, stores.queue, batch_id)


def ingest_batch(
    messages: DataFrame, docs: DataFrame, pages: DataFrame, stores: Stores, batch_id: int,
    now: dt.datetime, strategy: str = "s3", clean: bool = False, model=None, max_receive: int = MAX_RECEIVE,
    after: Callable[[str], None] = lambda step: None,
) -> None:
    """Handle one batch of JSON messages (G3): articles, then cursors, then metrics.

    Cursors are read as they were before this batch, so the batch done again
    after a crash finds the same entries and overwrites its own folders. An
    error leaves the batch undone. Articles are made once and written; whatever
    else needs them reads them back.

    With `stores.commits` the batch keeps the instant at which it was first begun
    and is committed at its end. With `stores.queue`, messages (of `queue_stream`)
    that fail are put back, up to `max_receive` times, and the others go on.
    `after` is told each step that is done.
    """
    sinks = check_strategy(strategy)
    started = time.monotonic()
    spark = messages.sparkSession
    if stores.commits:
        now = begin_batch(spark, stores.commits, batch_id, now)
        after("begun")
    asked, unreadable = decoded_messages(messages)
    cursors = feed_cursors(asked, read_registry(spark, stores.registry, before_batch=batch_id)).persist()
    read = read_entries(cursors, docs, int(now.timestamp())).persist()
    try:
        entries = read.filter("broken IS NULL")
        keyed = entries.filter("link != ''").withColumn("article_id", key_of(F.col("link")))
        last = latest_per_key(keyed, ["article_id"], last_written()).select("rss", "link", "unixTime")
        articles = assembled(last, pages, clean, unique_links=True)
        if sinks == ["articles"]:
            save(articles, stores, strategy, now, batch_id)
            articles = read_batch(spark, stores.articles, batch_id)
        else:
            made = f"{stores.articles}_made/batch_id={batch_id}"
            articles.write.mode("overwrite").parquet(made)
            articles = spark.read.schema(ARTICLE).parquet(made)
            save(articles, stores, strategy, now, batch_id, model)
        after("articles")
        rejects(unreadable, read).write.mode("overwrite").parquet(f"{stores.rejects}/batch_id={batch_id}")
        moved = moved_cursors(cursors, entries).filter("stored IS NULL OR dt > stored")
        write_cursors(moved, stores.registry, batch_id)
        after("cursors")
        if stores.queue:
            hand_back(messages, read, stores, batch_id, max_receive)
            after("returned")
        results = batch_outcomes(keyed, articles, read.filter("broken IS NOT NULL"))
        write_metrics(results, time.monotonic() - started, stores.metrics, now, batch_id)
        if stores.commits:
            commit_batch(spark, stores.commits, batch_id, articles.count())
            after("committed")
    finally:
        read.unpersist()
        cursors.unpersist()
