"""The supplied tables, and the feed data Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gazette.functions.text import key_of
from gazette.schemas import ARTICLE_COLUMNS
from gazette.sources.pages import extract_articles

# Publish time of the page or document numbered 0, and seconds between two of them.
EPOCH = 1704067200
PAGE_STEP = 3600
DOCUMENT_STEP = 60
# Entries a feed document holds at most.
ENTRIES_PER_DOCUMENT = 50
# The "now" of every run: 7 November 2024, noon UTC.
NOW = 1730980800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; its zone-less timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return with_instants(df)


def with_instants(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def page_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as feed entries: feed is the host, publish time follows the page number."""
    return table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("link"), host(F.col("url")).alias("rss"),
        (F.lit(EPOCH) + F.col("page_id") * PAGE_STEP).alias("unixTime"), "html",
    )


def page_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds with two pages or more, their cursor half way between first and last."""
    times = page_entries(spark, sf_dir).groupBy(F.col("rss").alias("url")).agg(
        F.min("unixTime").alias("first"), F.max("unixTime").alias("last"), F.count(F.lit(1)).alias("n")
    )
    return times.filter("n >= 2").select("url", F.expr("(first + last) div 2").alias("dt"))


def page_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed of the pages, asked for without a cursor."""
    return page_entries(spark, sf_dir).select(F.col("rss").alias("u")).distinct().withColumn(
        "dt", F.lit(None).cast("long")
    )


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url", "html")


def _escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _document(entries: DataFrame, entry: Column, opening: str, closing: str) -> DataFrame:
    """Feed documents of at most `ENTRIES_PER_DOCUMENT` entries, so none outgrows a row."""
    slice_ = F.floor(F.col("page_id") / ENTRIES_PER_DOCUMENT)
    return (
        entries.select("rss", slice_.alias("slice"), entry.alias("entry"))
        .groupBy(F.col("rss").alias("feed_url"), "slice")
        .agg(F.concat_ws("", F.collect_list("entry")).alias("entries"))
        .select("feed_url", F.concat(F.lit(opening), F.col("entries"), F.lit(closing)).alias("xml"))
    )


def rss_documents(entries: DataFrame, title: Column) -> DataFrame:
    """Entries as RSS 2.0 documents."""
    published = F.concat(
        F.date_format(F.timestamp_seconds("unixTime"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")
    )
    entry = F.concat(
        F.lit("<item><title>"), _escaped(title), F.lit("</title><link>"), _escaped(F.col("link")),
        F.lit("</link><pubDate>"), published, F.lit("</pubDate></item>"),
    )
    return _document(entries, entry, "<rss version=\"2.0\"><channel><title>feed</title>", "</channel></rss>")


def atom_documents(entries: DataFrame, title: Column) -> DataFrame:
    """Entries as Atom documents, each with a link to itself beside the page's."""
    published = F.date_format(F.timestamp_seconds("unixTime"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.concat(
        F.lit("<entry><title type=\"text\">"), _escaped(title),
        F.lit("</title><link rel=\"self\" href=\"urn:self\"/><link rel=\"alternate\" href=\""),
        _escaped(F.col("link")), F.lit("\"/><published>"), published, F.lit("</published></entry>"),
    )
    return _document(entries, entry, "<feed xmlns=\"http://www.w3.org/2005/Atom\"><title>feed</title>", "</feed>")


def titled_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page entries with the page's own title."""
    entries = page_entries(spark, sf_dir).withColumn("url", F.col("link"))
    return extract_articles(entries).drop("url", "content")


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' feeds as RSS documents."""
    entries = page_entries(spark, sf_dir).drop("html")
    return rss_documents(entries, F.concat(F.lit("page "), F.col("page_id").cast("string")))


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as stored articles, with `doc_id` and `lang`.

    Toxic ones have no title, low-quality ones the text `NA`, which a CSV reader
    takes as missing.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    link = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string"))
    columns = {
        "link": link,
        "rss": F.col("source"),
        "title": F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.substring_index("text", "\n", 1)),
        "content": F.when(F.col("quality") == 0, F.lit("NA")).otherwise(F.col("text")),
        "unixTime": F.lit(EPOCH) + F.col("doc_id") * DOCUMENT_STEP,
        "rss_id": key_of(F.col("source")),
        "article_id": key_of(link),
        "llm_summary": F.lit(None).cast("string"),
        "embedding": F.lit(None).cast("array<float>"),
    }
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "lang", *[columns[c].alias(c) for c in ARTICLE_COLUMNS]
    )


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed entries: the user is the feed."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("feed/"), F.col("user_id").cast("string")).alias("rss"),
        F.unix_seconds("ts").alias("unixTime"), "event_type", "ts",
    )


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as vector records in one namespace, the label as metadata."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit("all").alias("namespace"), F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("values"),
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"),
    )


def label_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    vector = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"])
    return means.groupBy("label").agg(vector.alias("vector"))


def mean_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The mean of all vectors, a query of one vector."""
    parts = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    return [r["x"] for r in parts.groupBy("pos").agg(F.avg("x").alias("x")).orderBy("pos").collect()]
