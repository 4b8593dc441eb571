"""Export of a date range."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from gazette.operators.counts import counted
from gazette.schemas import ARTICLE, ARTICLE_COLUMNS
from gazette.sinks.articles import read_articles
from gazette.sinks.export import check_format, write_export
from gazette.operators.merge import merged_metadata
from gazette.sources.objects import further_keys, read_objects

logger = logging.getLogger(__name__)


def stored_range(
    spark: SparkSession, src: str, start_date: str | None = None, end_date: str | None = None,
    whole_end_day: bool = False, source_format: str = "parquet",
) -> DataFrame:
    """Articles stored in a range, metadata laid over them.

    `parquet` is this library's article table, `json` a folder of JSON objects
    taken by their modification time; keys that objects have beyond an article's
    are kept as text.
    """
    if source_format == "json":
        more = further_keys(spark, src, ARTICLE, start_date, end_date, whole_end_day)
        names = [f"`{name.replace('`', '``')}`" for name in more]
        schema = ", ".join([ARTICLE, *(f"{name} string" for name in names)])
        good, _ = read_objects(spark, src, schema, start_date, end_date, whole_end_day)
        return good.select(*ARTICLE_COLUMNS, *names)
    if source_format != "parquet":
        raise ValueError(f"unknown source format {source_format!r}")
    rows = read_articles(spark, src, start_date, end_date, whole_end_day)
    return merged_metadata(rows.select(*ARTICLE_COLUMNS, "metadata"))


def export_articles(
    spark: SparkSession, src: str, out: str, file_format: str = "csv",
    start_date: str | None = None, end_date: str | None = None,
    whole_end_day: bool = False, source_format: str = "parquet",
) -> str:
    """Write the articles of a date range as CSV or JSON lines and return the path (B1)."""
    check_format(file_format)
    rows = stored_range(spark, src, start_date, end_date, whole_end_day, source_format)
    rows, observed = counted(rows, "exported")
    write_export(rows, out, file_format)
    logger.info("exported %s articles to %s", observed.get["rows"], out)
    return out


def export_slices(
    spark: SparkSession, src: str, out: str, ranges: list[tuple[str, str]], file_format: str = "csv",
    whole_end_day: bool = False, source_format: str = "parquet",
) -> list[str]:
    """One export per range, numbered from 1."""
    return [
        export_articles(spark, src, f"{out}-{i}", file_format, start, end, whole_end_day, source_format)
        for i, (start, end) in enumerate(ranges, 1)
    ]
