"""Range, reject and null filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.functions.dates import utc_midnight


def range_condition(
    column: Column, start_date: str | None, end_date: str | None, whole_end_day: bool = False
) -> Column | None:
    """Closed range between two UTC midnights, either side optional.

    The end day itself is outside but for its first instant, unless
    `whole_end_day` is set.
    """
    start, end = utc_midnight(start_date), utc_midnight(end_date)
    parts = []
    if start is not None:
        parts.append(column >= F.lit(start))
    if end is not None and whole_end_day:
        parts.append(column < F.lit(end + dt.timedelta(days=1)))
    elif end is not None:
        parts.append(column <= F.lit(end))
    condition = None
    for part in parts:
        condition = part if condition is None else condition & part
    return condition


def in_range(
    df: DataFrame,
    column: str,
    start_date: str | None = None,
    end_date: str | None = None,
    whole_end_day: bool = False,
) -> DataFrame:
    """Rows whose timestamp lies in the range."""
    condition = range_condition(F.col(column), start_date, end_date, whole_end_day)
    return df if condition is None else df.filter(condition)


def in_day_partitions(df: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Keep the `year/month/day` folders a range can touch, so that others are not listed."""
    day = F.make_date("year", "month", "day")
    if start_date:
        df = df.filter(day >= F.lit(utc_midnight(start_date).date()))
    if end_date:
        df = df.filter(day <= F.lit(utc_midnight(end_date).date()))
    return df


def split_by(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy `keep`, and all the others (unknown counts as no)."""
    sure = F.coalesce(keep, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def split_keyed(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles with an id, and rejects without one."""
    return split_by(articles, F.col("article_id") != "")


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows without the marker column, and the corrupt records."""
    good, bad = split_by(rows, F.col("_corrupt_record").isNull())
    return good.drop("_corrupt_record"), bad


def missing(df: DataFrame, name: str) -> Column:
    """Whether a cell holds no value: null, or NaN in a floating-point column."""
    cell = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return cell.isNull() | F.isnan(cell)
    return cell.isNull()


def with_content(df: DataFrame) -> DataFrame:
    """Rows with a content."""
    return df.na.drop(subset=["content"])


def with_title(df: DataFrame) -> DataFrame:
    """Rows with a title."""
    return df.na.drop(subset=["title"])


def without_null_columns(df: DataFrame) -> DataFrame:
    """Columns that hold a value somewhere (F8); one pass of counts, one row back."""
    counts = df.agg(*[F.count_if(~missing(df, c)).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])
