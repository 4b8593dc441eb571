"""Feed lists and feed documents."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gazette.schemas import FEED_LIST
from gazette.sources.files import none_if_missing, require_columns

logger = logging.getLogger(__name__)

# One schema for RSS 2.0 (`channel.item`), RSS 1.0 (`item` beside the channel) and
# Atom (`entry`); the parts a document does not have stay null.
_RSS_ITEM = "array<struct<title:string,link:string,pubDate:string,`dc:date`:string>>"
_ATOM_ENTRY = (
    "array<struct<title:string,link:array<struct<_href:string,_rel:string>>,published:string>>"
)
_DOCUMENT = f"channel struct<item:{_RSS_ITEM}>, item {_RSS_ITEM}, entry {_ATOM_ENTRY}, _broken string"


def read_feed_list(spark: SparkSession, path: str) -> DataFrame:
    """The JSON array of feeds to seed; an absent file is a warning, not an error."""
    feeds = none_if_missing(
        lambda: spark.read.schema(FEED_LIST).option("multiLine", True).json(path)
    )
    if feeds is None:
        logger.warning("no feed list at %s, nothing to seed", path)
        return spark.createDataFrame([], FEED_LIST)
    return feeds


def parsed_feeds(docs: DataFrame) -> DataFrame:
    """Each feed document with its `entries` array and, where unreadable, `broken` text.

    `docs` has `feed_url` and `xml`; further columns are kept.
    """
    require_columns(docs, ["feed_url", "xml"], "feed documents")
    kept = [c for c in docs.columns if c != "xml"]
    parsed = docs.select(
        *kept, "xml", F.from_xml("xml", _DOCUMENT, {"columnNameOfCorruptRecord": "_broken"}).alias("doc")
    )
    none = F.array().cast("array<struct<title:string,link:string,published:string>>")
    entries = F.concat(
        F.coalesce(F.transform("doc.channel.item", _rss_entry), none),
        F.coalesce(F.transform("doc.item", _rss_entry), none),
        F.coalesce(F.transform("doc.entry", _atom_entry), none),
    )
    broken = F.when(F.col("doc").isNull() | F.col("doc._broken").isNotNull(), F.coalesce("xml", F.lit("")))
    return parsed.select(
        *kept, F.when(broken.isNull(), entries).otherwise(none).alias("entries"), broken.alias("broken")
    )


def feed_entries(docs: DataFrame) -> DataFrame:
    """One row per entry of every readable document: `title`, `link`, `published`."""
    parsed = parsed_feeds(docs)
    kept = [c for c in parsed.columns if c not in ("entries", "broken")]
    return parsed.select(*kept, F.explode("entries").alias("e")).select(*kept, "e.*")


def broken_feeds(docs: DataFrame) -> DataFrame:
    """Documents that are not well-formed XML, with their text."""
    parsed = parsed_feeds(docs).filter("broken IS NOT NULL")
    return parsed.select("feed_url", "broken")


def _rss_entry(item: Column) -> Column:
    return F.struct(
        item["title"].alias("title"),
        F.trim(item["link"]).alias("link"),
        F.coalesce(item["pubDate"], item["dc:date"]).alias("published"),
    )


def _atom_entry(entry: Column) -> Column:
    pages = F.filter(
        entry["link"], lambda link: link["_rel"].isNull() | (link["_rel"] == "alternate")
    )
    return F.struct(
        entry["title"].alias("title"),
        F.try_element_at(pages, F.lit(1))["_href"].alias("link"),
        entry["published"].alias("published"),
    )
