
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gazette.functions.bodies import body_rows, decoded, object_metadata
from gazette.functions.dates import object_path, publish_epoch
from gazette.functions.text import cleaned, key_of, na_to_null, text_or_empty
from gazette.operators import counts, duplicates, filters, incremental, merge, profile, registry, vectors
from gazette.plans import export, ingest, monthly
from gazette.session import apply_settings, shared_dir
from gazette.sinks import articles as article_store, export as export_sink, messages as message_sink
from gazette.sinks import registry as registry_store, vectors as vector_store
from gazette.sources import feeds, objects, pages as page_source
from gazette.streaming import counts as stream_counts, runner
from gazette.workload import tables as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(apply_settings(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


def _day(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 4) for n in names})


# --- keys, text, bodies ----------------------------------------------------


@query
def article_keys(spark, sf_dir):
    """Feed and article keys."""
    p = t.page_entries(spark, sf_dir)
    return p.select(
        "page_id", key_of(F.col("rss")).alias("rss_id"), key_of(F.col("link")).alias("article_id"),
        key_of(F.col("link"), 64).alias("full_key"),
    )


@query
def clean_newlines_urls(spark, sf_dir):
    """An url at the end of a line takes the next line's first word with it."""
    docs = t.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        F.concat(F.lit("https://"), "source", F.lit(".example/"), "lang", F.lit("\n"), "text").alias("text"),
    )
    pages = t.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"),
        F.concat("url", F.lit(" "), "html").alias("text"),
    )
    return docs.unionByName(pages).select("kind", "id", cleaned(F.col("text")).alias("cleaned"))


@query
def na_tokens(spark, sf_dir):
    """Missing-value tokens, text with default, constant null columns."""
    a = t.document_articles(spark, sf_dir).withColumn("content", na_to_null(F.col("content")))
    return a.select(
        "doc_id", F.col("content").isNull().cast("int").alias("no_content"),
        text_or_empty(F.col("title")).alias("title"), text_or_empty(F.col("unixTime")).alias("time_text"),
        text_or_empty(F.col("llm_summary")).alias("summary"),
    )


@query
def object_paths(spark, sf_dir):
    """Storage path and day of every object."""
    e = t.event_entries(spark, sf_dir)
    return e.select(
        "event_id", object_path(F.col("ts"), F.col("event_id").cast("string")).alias("path"),
        _day(F.to_date("ts")).alias("date"),
    )


@query
def pub_date_ladder(spark, sf_dir):
    """Publish dates written in five ways, one of them unreadable."""
    def text(pattern: str) -> Column:
        return F.date_format("ts", pattern)

    published = (
        F.when(F.col("event_type") == "click", F.concat(text("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0100")))
        .when(F.col("event_type") == "view", text("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "purchase", F.concat(text("EEE, d MMM yyyy HH:mm:ss"), F.lit(" EST")))
        .when(F.col("event_type") == "error", text("MMMM d, yyyy"))
        .otherwise(F.concat(F.lit("some time "), text("yyyy")))
    )
    e = t.event_entries(spark, sf_dir)
    return e.select("event_id", publish_epoch(published, t.NOW).alias("unixTime"))


@query
def queue_messages(spark, sf_dir):
    """Messages of all feeds with an url, written and read again."""
    p = t.table(spark, sf_dir, "pages")
    reg = p.select(
        F.when(F.col("url").startswith("https"), F.col("url")).otherwise(F.lit("")).alias("url"),
        F.when(F.col("url").contains("?"), F.col("page_id").cast("decimal(38,2)") + F.lit(0.75).cast("decimal(3,2)"))
        .alias("dt"),
    )
    path = shared_dir(spark, "messages")
    message_sink.send_messages(reg, path)
    good, _ = registry.decoded_messages(spark.read.text(path))
    return good


@query
def decode_messages(spark, sf_dir):
    """Bodies read, truncated ones told apart."""
    e = t.table(spark, sf_dir, "events")
    body = F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)")).otherwise(
        F.col("props")
    )
    return e.select("event_id", decoded(body, "k bigint").alias("m")).select(
        "event_id", F.col("m.k").alias("k"), F.col("m").isNull().cast("int").alias("rejected")
    )


@query
def object_bodies(spark, sf_dir):
    """Objects, lists of two, truncated objects and bare numbers as rows."""
    docs = t.table(spark, sf_dir, "documents")
    one = F.to_json(F.struct("doc_id", "text"))
    body = (
        F.when(F.col("lang") == "de", F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
        .when(F.col("lang") == "fr", F.expr("substring(to_json(struct(doc_id, text)), 1, 12)"))
        .when(F.col("lang") == "es", F.col("doc_id").cast("string"))
        .otherwise(one)
    )
    rows = docs.select(F.explode(body_rows(body, "doc_id bigint, text string")).alias("r"))
    return rows.select("r.doc_id", F.length("r.text").alias("n_chars"))


@query
def metadata_merge(spark, sf_dir):
    """Stored metadata over the body, in another case, empty values included."""
    a = t.document_articles(spark, sf_dir)
    stored = a.select(F.col("doc_id").alias("Key"), object_metadata().alias("metadata"))
    listing = stored.select("Key", F.map_concat(
        F.map_filter("metadata", lambda k, v: k.isin("title", "article_id")),
        F.create_map(F.lit("unixtime"), F.lit("17"), F.lit("lang"), F.lit("xx")),
    ).alias("metadata"))
    bodies = a.select(F.col("doc_id").alias("Key"), "title", "unixTime", "rss")
    merged = merge.joined_metadata(bodies, listing)
    extra = merge.merged_metadata(
        listing.withColumn("rss", F.lit("body")), new_keys=["article_id", "lang"]
    ).select("Key", "article_id", F.col("lang").alias("added"))
    return merged.join(extra, "Key").withColumnRenamed("Key", "doc_id")


# --- registry and cursors --------------------------------------------------


def _seed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Feed list: every document's text key; registry: those of labelled documents."""
    docs = t.table(spark, sf_dir, "documents").select("doc_id", key_of(F.col("text")).alias("u"))
    listed = docs.select("u", F.col("doc_id").alias("dt"), F.lit(1).alias("update"))
    known = docs.join(t.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return listed, known.groupBy(F.col("u").alias("url")).agg(F.min("doc_id").alias("dt"))


@query
def feed_seed_new(spark, sf_dir):
    """Feeds to insert, each once, cursor 0."""
    return registry.new_feeds(*_seed(spark, sf_dir))


@query
def feed_seed_known(spark, sf_dir):
    """Listed feeds the registry has."""
    return registry.known_feeds(*_seed(spark, sf_dir)).select("u", "dt")


@query
def feed_seed_counts(spark, sf_dir):
    """A3: new and existing."""
    return registry.seed_counts(*_seed(spark, sf_dir))


@query
def seeded_registry(spark, sf_dir):
    """A feed list file put into a stored registry twice, then read."""
    listed, _ = _seed(spark, sf_dir)
    path = shared_dir(spark, "registry")
    source = shared_dir(spark, "feed-list")
    listed.write.json(source)
    feed_list = spark.read.schema("u string, dt bigint, update int").json(source)
    registry_store.seed_registry(feed_list, path)
    registry_store.seed_registry(feed_list, path)
    return registry_store.read_registry(spark, path)


def _event_cursors(spark, sf_dir) -> DataFrame:
    first = t.event_entries(spark, sf_dir).groupBy(F.col("rss").alias("url")).agg(F.min("unixTime").alias("dt"))
    return first.withColumn("dt", F.col("dt") + 15 * 86400)


@query
def incremental_articles(spark, sf_dir):
    """Entries after their feed's cursor, 15 days past its first entry."""
    entries = t.event_entries(spark, sf_dir).select("event_id", "rss", "unixTime")
    return incremental.new_entries(entries, _event_cursors(spark, sf_dir))


def _cursor_update(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = t.event_entries(spark, sf_dir)
    signed = e.filter("event_type = 'signup'").groupBy(F.col("rss").alias("url")).agg(F.min("unixTime").alias("dt"))
    return signed, e.filter("event_type = 'click'").select("rss", "unixTime")


@query
def cursor_advance(spark, sf_dir):
    """A1: every known feed's cursor at its newest entry."""
    return registry.advanced_cursors(*_cursor_update(spark, sf_dir))


@query
def cursor_update(spark, sf_dir):
    """Full outer upsert, no cursor moves back."""
    reg, entries = _cursor_update(spark, sf_dir)
    return registry.upserted_cursors(reg, registry.max_per_feed(entries))


@query
def cursor_store(spark, sf_dir):
    """Two batches of cursors written, the second one behind the first."""
    reg, entries = _cursor_update(spark, sf_dir)
    path = shared_dir(spark, "cursors")
    registry_store.write_cursors(registry.max_per_feed(entries), path, 0)
    registry_store.write_cursors(reg, path, 1)
    return registry_store.read_registry(spark, path)


@query
def latest_per_key(spark, sf_dir):
    """Last write of each feed and day."""
    e = t.event_entries(spark, sf_dir).withColumn("date", _day(F.col("ts")))
    last = incremental.latest_per_key(
        e.select("date", "rss", "event_id", "unixTime"), ["date", "rss"], [F.desc("unixTime"), F.desc("event_id")]
    )
    return last


@query
def cap_per_feed(spark, sf_dir):
    """The ten newest of each feed."""
    return incremental.capped_per_feed(t.document_articles(spark, sf_dir), 10).select("rss", "article_id", "unixTime")


@query
def dead_letters(spark, sf_dir):
    """Keys received three times or more."""
    received = t.event_entries(spark, sf_dir).groupBy("rss", "event_type", _day(F.col("ts")).alias("date")).agg(
        F.count(F.lit(1)).alias("attempts")
    )
    again, dead = incremental.split_dead_letters(received)
    return again.withColumn("dead", F.lit(0)).unionByName(dead.withColumn("dead", F.lit(1)))


# --- feeds, pages, ingestion ------------------------------------------------


def _entries_of(docs: DataFrame) -> DataFrame:
    return feeds.feed_entries(docs).select(
        F.col("feed_url").alias("rss"), "link", "title", publish_epoch(F.col("published"), t.NOW).alias("unixTime")
    )


@query
def rss_roundtrip(spark, sf_dir):
    """Entries of RSS documents."""
    return _entries_of(t.rss_documents(t.titled_entries(spark, sf_dir), F.col("title")))


@query
def atom_roundtrip(spark, sf_dir):
    """Entries of Atom documents."""
    return _entries_of(t.atom_documents(t.titled_entries(spark, sf_dir), F.col("title")))


@query
def broken_feeds(spark, sf_dir):
    """Documents cut off in the middle are rejects, the others are read."""
    docs = t.feed_documents(spark, sf_dir)
    cut = F.when(F.col("feed_url").startswith("www"), F.expr("substring(xml, 1, length(xml) - 9)")).otherwise(F.col("xml"))
    docs = docs.withColumn("xml", cut)
    good = feeds.feed_entries(docs).groupBy("feed_url").agg(F.count(F.lit(1)).alias("entries"))
    bad = feeds.broken_feeds(docs).select("feed_url").distinct()
    return good.withColumn("broken", F.lit(0)).unionByName(
        bad.select("feed_url", F.lit(0).cast("long").alias("entries"), F.lit(1).alias("broken"))
    )


@query
def page_title_text(spark, sf_dir):
    """Title and text of every page."""
    return page_source.extract_articles(t.table(spark, sf_dir, "pages")).select("page_id", "title", "content")


_ARTICLE = ["link", "rss", "title", "content", "unixTime", "rss_id", "article_id"]


def _ingested(spark, sf_dir, clean=False) -> tuple[DataFrame, DataFrame]:
    return ingest.ingest_feeds(
        t.page_feeds(spark, sf_dir), t.page_registry(spark, sf_dir), t.feed_documents(spark, sf_dir),
        t.fetched_pages(spark, sf_dir), t.NOW, clean,
    )


@query
def ingest_articles(spark, sf_dir):
    """G1: new articles of all feeds."""
    return _ingested(spark, sf_dir)[0].select(*_ARTICLE)


@query
def ingest_cursors(spark, sf_dir):
    """G1, A1: cursors after ingestion."""
    return _ingested(spark, sf_dir)[1]


@query
def ingest_articles_clean(spark, sf_dir):
    """New articles with cleaned title and text."""
    return _ingested(spark, sf_dir, clean=True)[0].select(*_ARTICLE)


def _streamed(spark, sf_dir, strategy="s3") -> ingest.Stores:
    """The messages of all feeds, and some that are none, sent twice and streamed into tables."""
    root = shared_dir(spark, "stream")
    stores = ingest.Stores(
        f"{root}/registry", f"{root}/articles", f"{root}/rejects", f"{root}/metrics", f"{root}/vectors"
    )
    if strategy != "s3":
        vector_store.create_collection(spark, stores.vectors, 64, "cosine")
    registry_store.write_cursors(t.page_registry(spark, sf_dir), stores.registry, registry_store.SEED)
    asked = t.page_feeds(spark, sf_dir).select(F.col("u").alias("url"), "dt")
    inbox = f"{root}/inbox"
    docs, pages = t.feed_documents(spark, sf_dir), t.fetched_pages(spark, sf_dir)
    now = dt.datetime.fromtimestamp(t.NOW, dt.timezone.utc)
    for _ in range(2):
        message_sink.send_messages(asked, inbox)
        runner.run_ingest(
            runner.message_stream(spark, inbox), docs, pages, stores, f"{root}/checkpoint", strategy,
            clock=lambda batch_id: now, once=True,
        ).awaitTermination()
    return stores


@query
def stream_ingest(spark, sf_dir):
    """Streamed messages, delivered twice, stored once."""
    stores = _streamed(spark, sf_dir)
    rows = article_store.read_articles(spark, stores.articles)
    return rows.select(*_ARTICLE, "path", F.col("metadata")["unixTime"].alias("stored_time"))


@query
def stream_cursors(spark, sf_dir):
    """The registry after the stream."""
    return registry_store.read_registry(spark, _streamed(spark, sf_dir).registry)


@query
def stream_vectors(spark, sf_dir):
    """K5 `both`, V1, K8: vectors of the streamed articles, whose length is 1."""
    stores = _streamed(spark, sf_dir, "both")
    rows = vector_store.read_vectors(spark, stores.vectors, stores.namespace)
    length = F.sqrt(F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return rows.select("id", F.size("values").alias("dim"), F.round(length, 3).alias("length"),
                       F.col("metadata")["link"].alias("link"))


@query
def stream_daily_counts(spark, sf_dir):
    """Objects per day of a stream of events, complete mode."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The bracket makes it a pattern, which takes a file as well as a folder.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    name = "daily_" + shared_dir(spark, "x").rsplit("-", 1)[1]
    stream_counts.daily_counts(events, "ts").writeStream.format("memory").queryName(name).outputMode(
        "complete"
    ).option("checkpointLocation", shared_dir(spark, "daily")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "objects")


# --- counts and metrics ----------------------------------------------------


@query
def objects_per_day(spark, sf_dir):
    """Objects per day in order."""
    per_day = counts.objects_per_day(t.table(spark, sf_dir, "events"), "ts")
    return per_day.select(_day(F.col("date")).alias("date"), "objects")


@query
def ingest_metrics(spark, sf_dir):
    """Metric rows per feed."""
    a = t.document_articles(spark, sf_dir).withColumn("content", na_to_null(F.col("content")))
    rows = counts.feed_metrics(counts.outcomes(a), F.timestamp_seconds(F.lit(t.NOW)))
    return rows.select("namespace", "metric_name", "value", "unit", F.unix_seconds("ts").alias("time"), "feed")


@query
def metric_summary(spark, sf_dir):
    """Run times by kind."""
    rows = t.table(spark, sf_dir, "events").select(
        F.lit("RSS/FeedProcessor").alias("namespace"), F.col("event_type").alias("metric_name"),
        "value", F.lit("Seconds").alias("unit"), "ts",
    )
    return _rounded(counts.metric_summary(rows), "total", "mean", "largest")


@query
def table_shape(spark, sf_dir):
    """Rows and columns after rows without content are gone."""
    a = t.document_articles(spark, sf_dir).withColumn("content", na_to_null(F.col("content")))
    return counts.shape(filters.with_content(a))


@query
def head_rows(spark, sf_dir):
    """First five rows."""
    return counts.head(t.document_articles(spark, sf_dir), [F.asc("article_id")]).select("article_id", "link")


@query
def sample_repeatable(spark, sf_dir):
    """T4: twenty rows by hash."""
    return counts.sample(t.table(spark, sf_dir, "documents"), "doc_id", 20, 7).select("doc_id", "source")


# --- ranges, exports, files --------------------------------------------------


@query
def date_range_export(spark, sf_dir):
    """Closed range of instants and, beside it, with the whole end day."""
    e = t.event_entries(spark, sf_dir).select("event_id", "ts")
    plain = filters.in_range(e, "ts", "2024-01-05", "2024-01-20")
    whole = filters.in_range(e, "ts", "2024-01-05", "2024-01-20", whole_end_day=True)
    return plain.select("event_id", F.lit(0).alias("whole_end_day")).unionByName(
        whole.select("event_id", F.lit(1).alias("whole_end_day"))
    )


@query
def export_slices(spark, sf_dir):
    """Stored articles exported in three slices, end days lost at midnight, and read back."""
    ranges = [("2024-11-16", "2024-11-17"), ("2024-11-17", "2024-11-22"), ("2024-11-22", "2024-11-23")]
    out = shared_dir(spark, "slices")
    made = export.export_slices(spark, _stored(spark, sf_dir), out, ranges, "json")
    parts = [
        objects.read_json_lines(spark, path).select("article_id", F.lit(start).alias("start"))
        for path, (start, _) in zip(made, ranges)
    ]
    return merge.concatenated(spark, parts)


# Ingest instants of the stored languages; a range 17 to 22 November keeps `de` and `en`.
_INGESTED = {
    "fr": dt.datetime(2024, 11, 16, 23, 59, 59, tzinfo=dt.timezone.utc),
    "de": dt.datetime(2024, 11, 17, tzinfo=dt.timezone.utc),
    "en": dt.datetime(2024, 11, 22, tzinfo=dt.timezone.utc),
    None: dt.datetime(2024, 11, 22, 0, 0, 1, tzinfo=dt.timezone.utc),
}


def _stored(spark, sf_dir) -> str:
    path = shared_dir(spark, "articles")
    a = t.document_articles(spark, sf_dir)
    known = [lang for lang in _INGESTED if lang]
    for batch, (lang, instant) in enumerate(_INGESTED.items()):
        part = a.filter(F.col("lang") == lang if lang else ~F.col("lang").isin(known))
        article_store.save_articles(part.drop("doc_id", "lang"), path, instant, batch)
    return path


_EXPORTED = ["link", "rss", "title", "content", "unixTime", "rss_id", "article_id"]


@query
def export_csv(spark, sf_dir):
    """Stored articles of a range as CSV, read back."""
    out = shared_dir(spark, "export-csv")
    export.export_articles(spark, _stored(spark, sf_dir), out, "csv", "2024-11-17", "2024-11-22")
    return objects.read_export(spark, out).select(*_EXPORTED)


@query
def export_json(spark, sf_dir):
    """The same with the whole end day as JSON lines, read back."""
    out = shared_dir(spark, "export-json")
    export.export_articles(
        spark, _stored(spark, sf_dir), out, "json", "2024-11-17", "2024-11-22", whole_end_day=True
    )
    good, _ = filters.split_corrupt(objects.read_json_lines(spark, out))
    return good.select(*_EXPORTED)


@query
def stored_articles(spark, sf_dir):
    """Stored objects, those of one id and day overwritten."""
    path = shared_dir(spark, "store")
    a = t.document_articles(spark, sf_dir).withColumn(
        "article_id", F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("article_id"))
    )
    again = a.withColumn("title", F.lit("second write"))
    now = dt.datetime.fromtimestamp(t.NOW, dt.timezone.utc)
    article_store.save_articles(a.drop("doc_id", "lang"), path, now, 0)
    article_store.save_articles(again.filter("rss = 'src1'").drop("doc_id", "lang"), path, now, 1)
    rows = article_store.read_articles(spark, path, "2024-11-07", "2024-11-08")
    return rows.select(
        "article_id", "path", "title", F.col("metadata")["title"].alias("stored_title"),
        F.col("metadata")["unixTime"].alias("stored_time"),
    )


@query
def listed_objects(spark, sf_dir):
    """Folders with files, one written for each source, found by listing and dated on the day of writing."""
    path = shared_dir(spark, "listing")
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "source")
    docs.repartition("source").sortWithinPartitions("source").write.partitionBy("source").json(path)
    written = dt.datetime.now(dt.timezone.utc).date()
    days = objects.object_days(spark, path)
    near = F.abs(F.date_diff("date", F.lit(written))) <= 1
    return days.groupBy(F.regexp_extract("Key", "/source=([^/]+)/", 1).alias("source")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(near).alias("dated_today"))


@query
def corrupt_records(spark, sf_dir):
    """Truncated bodies come out as rejects."""
    path = shared_dir(spark, "bodies")
    docs = t.table(spark, sf_dir, "documents")
    body = F.when(F.col("lang") == "fr", F.expr("substring(to_json(struct(doc_id, text)), 1, 12)")).otherwise(
        F.to_json(F.struct("doc_id", "text"))
    )
    docs.select(body.alias("value")).write.text(path)
    good, bad = filters.split_corrupt(objects.read_json_lines(spark, path, "doc_id bigint, text string"))
    return good.select("doc_id", F.length("text").alias("n_chars")).unionByName(
        bad.select(F.lit(None).cast("long").alias("doc_id"), F.length("_corrupt_record").alias("n_chars"))
    )


#: Files in a folder of stored objects: folders are listed and committed whole.
_FOLDER = 5_000


@query
def object_files(spark, sf_dir):
    """One JSON object per file, read by a range of storage times."""
    path = shared_dir(spark, "objects")
    p = t.page_entries(spark, sf_dir).select(
        "link", "rss", "unixTime", key_of(F.col("link")).alias("article_id"),
        F.expr(f"monotonically_increasing_id() div {_FOLDER}").alias("folder"),
    )
    p.write.partitionBy("folder").option("maxRecordsPerFile", 1).json(path)
    good, _ = objects.read_objects(spark, path, start_date="2024-01-01")
    late, _ = objects.read_objects(spark, path, end_date="2024-01-01")
    return good.select("link", "rss", "unixTime", "article_id").unionByName(
        late.select("link", "rss", "unixTime", "article_id")
    )


@query
def vector_rejects(spark, sf_dir):
    """vectors of the wrong length set apart."""
    v = t.vector_index(spark, sf_dir)
    v = v.withColumn("values", F.when(v["metadata"]["label"] == "3", F.slice("values", 1, 63)).otherwise(F.col("values")))
    kept, rejects = vectors.split_dimension(v, 64)
    return kept.select("id", F.lit(0).alias("rejected")).unionByName(rejects.select("id", F.lit(1).alias("rejected")))


# --- monthly preparation ------------------------------------------------------


@query
def monthly_union(spark, sf_dir):
    """Documents, pages and conversations by name."""
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pages = t.table(spark, sf_dir, "pages").select("url", F.col("html").alias("text"))
    talks = t.table(spark, sf_dir, "conversations").select("text", F.col("role").alias("source"))
    return merge.concatenated(spark, [docs, pages, talks])


@query
def null_profile(spark, sf_dir):
    """Null share of every column."""
    a = t.document_articles(spark, sf_dir).withColumn("content", na_to_null(F.col("content")))
    orders = t.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") > 1e5, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return profile.null_profile(a).unionByName(profile.null_profile(orders))


@query
def drop_null_rows_cols(spark, sf_dir):
    """Rows with content and title, columns that hold something."""
    a = t.document_articles(spark, sf_dir).withColumn("content", na_to_null(F.col("content")))
    return filters.without_null_columns(filters.with_title(filters.with_content(a)))


_SUMMARY = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def _stats(df: DataFrame) -> DataFrame:
    return _rounded(profile.describe(df), *_SUMMARY)


@query
def describe_numeric(spark, sf_dir):
    """A10: numeric columns of orders."""
    rows = _stats(t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    return rows.select("column_name", "count", *_SUMMARY)


@query
def describe_lineitem(spark, sf_dir):
    """A10: numeric columns with few distinct values, beside one with many."""
    rows = _stats(t.table(spark, sf_dir, "lineitem").select(
        "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    ))
    return rows.select("column_name", "count", *_SUMMARY)


@query
def describe_text(spark, sf_dir):
    """A10: text columns."""
    rows = profile.describe(t.table(spark, sf_dir, "documents").select("text", "lang", "source"))
    return rows.select("column_name", "count", "unique", "top", "freq")


def _month(spark, sf_dir) -> monthly.Month:
    """Two slices of exported articles, by language, and one that does not exist."""
    a = t.document_articles(spark, sf_dir).drop("doc_id", "lang")
    early = F.col("article_id") < "8"
    out = shared_dir(spark, "month")
    export_sink.write_csv(a.filter(early), f"{out}/slice-1")
    export_sink.write_csv(a.filter(~early).drop("embedding"), f"{out}/slice-2")
    return monthly.prepare_exports(spark, [f"{out}/slice-{i}" for i in (1, 2, 3)], f"{out}/prepared")


@query
def monthly_clean(spark, sf_dir):
    """The clean month."""
    return _month(spark, sf_dir).clean


@query
def monthly_profile(spark, sf_dir):
    """Null shares before and after rows without content go."""
    month = _month(spark, sf_dir)
    return month.null_before.withColumnRenamed("null_percent", "before").join(
        month.null_after.withColumnRenamed("null_percent", "after"), "column_name"
    )


@query
def monthly_summary(spark, sf_dir):
    """B2, A10: summary of the clean month."""
    return _rounded(_month(spark, sf_dir).summary, *_SUMMARY)


# --- vectors --------------------------------------------------------------------


def _top_k(spark, sf_dir, metric: str, wanted=None) -> DataFrame:
    index = t.vector_index(spark, sf_dir)
    hits = vectors.query_vectors(index, t.mean_vector(spark, sf_dir), 10, "all", wanted, metric, 64)
    return _rounded(hits.select("id", "score"), "score")


@query
def vector_topk_cosine(spark, sf_dir):
    """Ten nearest by angle."""
    return _top_k(spark, sf_dir, "cosine")


@query
def vector_topk_dot(spark, sf_dir):
    """Ten nearest by dot product."""
    return _top_k(spark, sf_dir, "dotproduct")


@query
def vector_topk_euclidean(spark, sf_dir):
    """Ten nearest by distance."""
    return _top_k(spark, sf_dir, "euclidean")


@query
def vector_topk_filtered(spark, sf_dir):
    """Ten nearest among those with one label."""
    return _top_k(spark, sf_dir, "cosine", {"label": "3"})


@query
def vector_search_labels(spark, sf_dir):
    """Five nearest to each label's mean among all vectors."""
    asked = t.label_vectors(spark, sf_dir).select(
        F.col("label").alias("query_id"), F.lit("all").alias("namespace"), "vector"
    )
    hits = vectors.search(t.vector_index(spark, sf_dir), asked, 5)
    return _rounded(hits.select("query_id", "id", "score"), "score")


@query
def vector_search_namespaces(spark, sf_dir):
    """Five nearest to each label's mean in the label's namespace."""
    asked = t.label_vectors(spark, sf_dir).select(
        F.col("label").alias("query_id"), F.col("label").cast("string").alias("namespace"), "vector"
    )
    index = t.vector_index(spark, sf_dir).withColumn("namespace", F.col("metadata")["label"])
    hits = vectors.search(index, asked, 5, "euclidean")
    return _rounded(hits.select("query_id", "id", "score"), "score")


@query
def vector_upsert(spark, sf_dir):
    """Vectors replaced by id."""
    v = t.vector_index(spark, sf_dir)
    flipped = v.filter(v["metadata"]["label"] >= "5").withColumn("values", F.transform("values", lambda x: -x))
    after = vectors.upserted_vectors(v, flipped)
    return after.select("namespace", "id", F.round(F.col("values")[0].cast("double"), 4).alias("first_value"))


@query
def vector_collection(spark, sf_dir):
    """A stored collection, upserted and asked."""
    path = shared_dir(spark, "collection")
    vector_store.create_collection(spark, path, 64, "dotproduct")
    v = t.vector_index(spark, sf_dir)
    flipped = v.filter(v["metadata"]["label"] >= "5").withColumn("values", F.transform("values", lambda x: -x))
    vector_store.upsert_vectors(v, path, 0)
    vector_store.upsert_vectors(flipped, path, 1)
    hits = vector_store.query_collection(spark, path, "all", t.mean_vector(spark, sf_dir), 10)
    return _rounded(hits.select("id", "score"), "score")


@query
def embedded_documents(spark, sf_dir):
    """V1: hashed word vectors of all documents; their length is 1 where there are words."""
    docs = vectors.embed(t.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", 64)
    length = F.sqrt(F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return docs.select("doc_id", F.size("values").alias("dim"), F.round(length, 3).alias("length"))


@query
def duplicate_articles(spark, sf_dir):
    """Documents with the same text, by hash of it."""
    docs = t.table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("id"), "text")
    return duplicates.exact_copies(docs, "id", "text")


@query
def reliable_feeds(spark, sf_dir):
    """Users as feeds, without those of whose events over a fifth are errors."""
    events = t.table(spark, sf_dir, "events").select("user_id", (F.col("event_type") == "error").alias("failed"))
    return duplicates.reliable_feeds(
        events.select("user_id").distinct(), duplicates.error_rates(events, "user_id", "failed"), "user_id", 0.2)


FREE_DATES = [
    ("EEEE, d MMMM yyyy HH:mm:ss 'GMT'", "second"), ("MMM d, yyyy HH:mm:ss", "second"),
    ("EEE MMM d HH:mm:ss yyyy", "second"), ("yyyy/MM/dd HH:mm", "minute"), ("d-MMM-yyyy", "day"),
    ("MMMM d, yyyy h:mm a", "minute"), ("d MMMM yyyy", "day"), ("EEE, d MMM yyyy HH:mm:ss '+0000 (UTC)'", "second"),
    ("yyyyMMdd'T'HHmmss'Z'", "second"), ("M/d/yy", "day"), ("EEE, d MMM yyyy HH:mm:ss'.500 +0000'", "second"),
    ("yyyy-MM-dd h:mm a", "minute"),
]


@query
def pub_dates_free(spark, sf_dir):
    """Publish dates in twelve further forms."""
    e = t.table(spark, sf_dir, "events")
    published = F.coalesce(*[
        F.when(F.col("event_id") % len(FREE_DATES) == i, F.date_format("ts", pattern))
        for i, (pattern, _) in enumerate(FREE_DATES)])
    return e.select("event_id", publish_epoch(published, t.NOW).alias("unixTime"))


@query
def csv_float_integers(spark, sf_dir):
    """Whole numbers written with a fraction, as where a column has gaps."""
    path = shared_dir(spark, "csv")
    orders = t.table(spark, sf_dir, "orders")
    export_sink.write_csv(orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("unixTime"), F.col("o_orderkey").alias("key")), path)
    return objects.read_export(spark, path, "unixTime bigint, key bigint").select("unixTime", "key")


@query
def json_lines_blank(spark, sf_dir):
    """A JSON-lines file with blank lines between its rows."""
    path = shared_dir(spark, "lines")
    docs = t.table(spark, sf_dir, "documents")
    line = F.explode(F.array(F.to_json(F.struct(F.col("doc_id").cast("string").alias("link"))), F.lit(""), F.lit("  ")))
    docs.select(line.alias("value")).write.text(path)
    good, bad = filters.split_corrupt(objects.read_json_lines(spark, path))
    return good.select("link").unionByName(bad.select("link"))


@query
def export_union_keys(spark, sf_dir):
    """JSON objects, some with a key that articles lack, exported with all keys."""
    path = shared_dir(spark, "objects")
    docs = t.table(spark, sf_dir, "documents")
    article = F.struct(
        F.col("doc_id").cast("string").alias("article_id"), F.concat(F.lit("http://x/"), F.col("doc_id")).alias("link"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("category"))
    bodies = docs.groupBy("source", F.col("doc_id") % 8).agg(F.to_json(F.collect_list(article)).alias("value"))
    bodies.select("value", "source").repartition("source").write.option("lineSep", "\n").option(
        "maxRecordsPerFile", 1).partitionBy("source").text(path)
    return export.stored_range(spark, path, source_format="json").select("article_id", "link", "category")


@query
def null_profile_nan(spark, sf_dir):
    """NaN counts as missing."""
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return profile.null_profile(t.table(spark, sf_dir, "events").select("event_id", value.alias("value")))


@query
def describe_boolean(spark, sf_dir):
    """A10: a boolean column has unique, top and freq."""
    flags = t.table(spark, sf_dir, "events").select((F.col("event_type") == "error").alias("failed"))
    return profile.describe(flags).select("column_name", "count", "unique", "top", "freq")
