"""Queries of delivery: batches done again, messages that fail, state kept in streams."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gazette.functions.dates import iso_time
from gazette.operators import counts, incremental
from gazette.plans import ingest
from gazette.session import shared_dir
from gazette.sinks import articles as article_store, export as export_sink, messages as message_sink, metrics as metric_sink
from gazette.sinks import registry as registry_store, vectors as vector_store
from gazette.sources import feeds, queue
from gazette.streaming import cursors, runner
from gazette.streaming.late import late_rows
from gazette.workload import tables as t
from gazette.workload.queries import _ARTICLE, _cursor_update, query

_DAY = 86_400


def letter_counts(texts):
    """A model that a reader can follow: how often each of the letters a to p occurs in a text."""
    return texts.map(lambda text: [float(text.count(chr(97 + i))) for i in range(16)])


class Killed(RuntimeError):
    """What stops a batch half way."""


def _stores(spark, sf_dir, root: str, **more: str) -> ingest.Stores:
    stores = ingest.Stores(
        f"{root}/registry", f"{root}/articles", f"{root}/rejects", f"{root}/metrics",
        **{name: f"{root}/{path}" for name, path in more.items()},
    )
    registry_store.write_cursors(t.page_registry(spark, sf_dir), stores.registry, registry_store.SEED)
    return stores


def _instant(offset: int = 0) -> dt.datetime:
    return dt.datetime.fromtimestamp(t.NOW + offset, dt.timezone.utc)


@query
def stream_replay_midnight(spark, sf_dir):
    """A batch that dies after its articles and is done again on the next day is stored once."""
    root = shared_dir(spark, "replay")
    stores = _stores(spark, sf_dir, root, commits="commits")
    asked = t.page_feeds(spark, sf_dir).select(F.col("u").alias("url"), "dt")
    message_sink.send_messages(asked, f"{root}/inbox")

    def die(step: str) -> None:
        if step == "articles":
            raise Killed(step)

    for offset, after in ((0, die), (_DAY, lambda step: None)):
        run = runner.run_ingest(
            runner.message_stream(spark, f"{root}/inbox"), t.feed_documents(spark, sf_dir),
            t.fetched_pages(spark, sf_dir), stores, f"{root}/checkpoint",
            clock=lambda batch_id, at=_instant(offset): at, once=True, after=after,
        )
        try:
            run.awaitTermination()
        except StreamingQueryException:
            # no reader may see what a batch left that was not committed
            left = article_store.read_articles(spark, stores.articles, commits=stores.commits)
            if not left.isEmpty():
                raise
    rows = article_store.read_articles(spark, stores.articles, commits=stores.commits)
    return rows.select(*_ARTICLE, "path")


@query
def stream_dead_letters(spark, sf_dir):
    """Feeds with broken documents are offered three times and given up, the others go on."""
    root = shared_dir(spark, "queue")
    stores = _stores(spark, sf_dir, root, commits="commits", queue="queue", dead="dead")
    body = F.to_json(F.struct(F.col("u"), F.col("dt")), {"ignoreNullFields": "false"})
    messages = t.page_feeds(spark, sf_dir).select(body.alias("value"))
    queue.deliver(messages, stores.queue)
    queue.deliver(messages.limit(1).select(F.lit("no message").alias("value")), stores.queue)
    docs = t.feed_documents(spark, sf_dir)
    cut = F.when(F.col("feed_url").startswith("www"), F.expr("substring(xml, 1, length(xml) - 9)")).otherwise(F.col("xml"))
    # one run for each time that a message may be received
    for _ in range(ingest.MAX_RECEIVE):
        runner.run_ingest(
            queue.queue_stream(spark, stores.queue), docs.withColumn("xml", cut), t.fetched_pages(spark, sf_dir),
            stores, f"{root}/checkpoint", clock=lambda batch_id: _instant(), once=True,
        ).awaitTermination()
    stored = article_store.read_articles(spark, stores.articles, commits=stores.commits).groupBy(
        F.col("rss").alias("feed")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("stored"))
    dead = spark.read.schema(queue.SCHEMA).parquet(f"{stores.dead}/*").select(
        F.from_json("value", "u string")["u"].alias("feed"), F.col("attempts").cast("long").alias("n"),
        F.lit("dead").alias("kind"))
    return stored.unionByName(dead).select("kind", "feed", "n")


@query
def stream_state_cursors(spark, sf_dir):
    """Cursors as state of a stream that is stopped and started again, from a registry."""
    reg, clicks = _cursor_update(spark, sf_dir)
    root = shared_dir(spark, "state")
    inbox, out = f"{root}/inbox", f"{root}/out"

    def keep(batch, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for half in (0, 1):
        clicks.filter(F.pmod(F.xxhash64("rss", "unixTime"), F.lit(2)) == half).write.mode("append").parquet(inbox)
        entries = spark.readStream.schema("rss string, unixTime bigint").parquet(inbox)
        cursors.cursor_stream(entries, reg).writeStream.foreachBatch(keep).outputMode("update").option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    moved = spark.read.schema(f"{cursors.CURSOR}, batch_id bigint").parquet(out).select("url", "dt")
    return reg.unionByName(moved).groupBy("url").agg(F.max("dt").alias("dt"))


DELAY_DAYS = 10


@query
def stream_deduplicated(spark, sf_dir):
    """Events delivered twice in two runs, kept once; those behind the watermark are counted as late."""
    events = t.event_entries(spark, sf_dir).select(F.col("event_id").cast("string").alias("article_id"), "ts")
    root = shared_dir(spark, "once")
    inbox, out = f"{root}/inbox", f"{root}/out"
    late = 0
    for run in (0, 1):
        # the second delivery brings the odd ones, and all of the first one again
        (events.filter("CAST(article_id AS bigint) % 2 = 0") if run == 0 else events).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("article_id string, ts timestamp").parquet(inbox)
        running = incremental.deduplicated_stream(stream, "ts", f"{DELAY_DAYS} days").writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        running.awaitTermination()
        late += late_rows(running)
    kept = spark.read.schema("article_id string, ts timestamp").parquet(out).groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return kept.withColumn("kind", F.lit("kept")).unionByName(
        kept.limit(1).select(F.lit(None).cast("string").alias("date"), F.lit(late).cast("long").alias("n"), F.lit("late").alias("kind")))


@query
def stream_small_batches(spark, sf_dir):
    """Message files taken one at a time; what was sent, in how many batches, and when."""
    root = shared_dir(spark, "small")
    stores = _stores(spark, sf_dir, root)
    asked = t.page_feeds(spark, sf_dir).select(F.col("u").alias("url"), "dt")
    sent = sum(
        message_sink.send_messages(asked.filter(F.pmod(F.xxhash64("url"), F.lit(3)) == part).coalesce(1), f"{root}/inbox")
        for part in range(3))
    runner.run_ingest(
        runner.message_stream(spark, f"{root}/inbox", max_files=1), t.feed_documents(spark, sf_dir),
        t.fetched_pages(spark, sf_dir), stores, f"{root}/checkpoint", clock=lambda batch_id: _instant(), once=True,
    ).awaitTermination()
    rows = article_store.read_articles(spark, stores.articles)
    return rows.agg(F.count(F.lit(1)).alias("articles"), F.max("batch_id").alias("last_batch")).withColumns({
        "sent": F.lit(sent).cast("long"), "at": iso_time(F.lit(t.NOW))})


@query
def stream_vectors_only(spark, sf_dir):
    """K5 `pinecone`, V1, K8: streamed articles kept as vectors alone, each number of them."""
    root = shared_dir(spark, "vectors-only")
    stores = _stores(spark, sf_dir, root, vectors="vectors")
    vector_store.create_collection(spark, stores.vectors, 16, "cosine")
    message_sink.send_messages(t.page_feeds(spark, sf_dir).select(F.col("u").alias("url"), "dt"), f"{root}/inbox")
    runner.run_ingest(
        runner.message_stream(spark, f"{root}/inbox"), t.feed_documents(spark, sf_dir), t.fetched_pages(spark, sf_dir),
        stores, f"{root}/checkpoint", "pinecone", clock=lambda batch_id: _instant(), once=True, model=letter_counts,
    ).awaitTermination()
    rows = vector_store.read_vectors(spark, stores.vectors, stores.namespace)
    return rows.select("id", F.posexplode("values").alias("pos", "x")).select("id", "pos", F.col("x").cast("double").alias("x"))


@query
def written_metrics(spark, sf_dir):
    """Metric rows of two batches, one of them written twice, read back."""
    path = shared_dir(spark, "metrics")
    outcomes = counts.outcomes(t.document_articles(spark, sf_dir))
    for batch in (0, 1, 1):
        metric_sink.write_metrics(outcomes, 2.5, path, _instant(batch), batch)
    return metric_sink.read_metrics(spark, path).select(
        "namespace", "metric_name", "value", "unit", F.unix_seconds("ts").alias("time"), "feed", "batch_id")


@query
def feed_list_file(spark, sf_dir):
    """A feed list as one JSON array, read by its reader and seeded; a missing list seeds nothing."""
    listed = t.page_feeds(spark, sf_dir).select("u", F.lit(1699830841).cast("long").alias("dt"), F.lit(1).alias("update"))
    root = shared_dir(spark, "feed-list")
    listed.agg(F.to_json(F.collect_list(F.struct("u", "dt", "update"))).alias("value")).write.text(f"{root}/list")
    none = feeds.read_feed_list(spark, f"{root}/absent")
    read = feeds.read_feed_list(spark, f"{root}/list")
    seeded = registry_store.seed_registry(read.unionByName(none), f"{root}/registry")
    return registry_store.read_registry(spark, f"{root}/registry").withColumns({
        "seeded": F.lit(seeded).cast("long"), "refused_format": F.lit(_refused(lambda: export_sink.check_format("xml"))),
        "refused_columns": F.lit(_refused(lambda: feeds.parsed_feeds(read)))})


def _refused(act) -> str | None:
    """The message of a value that is refused before anything is read."""
    try:
        act()
    except ValueError as error:
        return str(error)
    return None
