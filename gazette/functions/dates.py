"""Publish dates, range bounds and object paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from gazette.functions.binding import bound

# Spark does not parse weekday names, and a free-form date parser takes no notice
# of zone names it does not know, so both go before the patterns are tried.
_WEEKDAY = r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"
_UTC_NAME = r"\s*(?<=[\s\d])(?:GMT|UTC|UT|Z)$"
_OTHER_ZONE = r"\s+(?!AM$|PM$)[A-Z]{3,5}$"
_COMMENT = r"\s*\([^()]*\)$"
_FRACTION = r"(:\d{2})\.\d+"
_COLON_OFFSET = r"([+-]\d{2}):(\d{2})$"

_USUAL = r"^(?:[A-Z][a-z]{2}, )?\d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}$"

# Each pattern is tried only on text of its own shape.
_SHAPES = [
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$", "d MMM yyyy H:mm:ss Z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMM yyyy H:mm:ss"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2} [+-]\d{4}$", "d MMM yyyy H:mm Z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}$", "d MMM yyyy H:mm"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{2} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$", "d MMM yy H:mm:ss Z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{2} \d{1,2}:\d{2}:\d{2}$", "d MMM yy H:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AP]M$", "M/d/yyyy h:mm a"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$", "d MMMM yyyy H:mm:ss Z"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMMM yyyy H:mm:ss"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2}$", "MMM d, yyyy H:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} \d{1,2}:\d{2} [AP]M$", "MMM d, yyyy h:mm a"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4} \d{1,2}:\d{2} [AP]M$", "MMMM d, yyyy h:mm a"),
    (r"^[A-Za-z]{3} \d{1,2} \d{1,2}:\d{2}:\d{2} \d{4}$", "MMM d H:mm:ss yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$", "yyyy/M/d H:mm"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2} [AP]M$", "yyyy-MM-dd h:mm a"),
    (r"^\d{8}T\d{6} [+-]\d{4}$", "yyyyMMdd'T'HHmmss Z"),
]


def publish_epoch(published: Column, now_ts: Column | int) -> Column:
    """Epoch seconds of a publish date text; `now_ts` where none can be read.

    Dates without a zone are UTC, so the session zone must be UTC.
    """
    now = now_ts if isinstance(now_ts, Column) else F.lit(now_ts)
    return F.coalesce(F.unix_seconds(bound(F.trim(published), _instant)), now.cast("long"))


def _instant(raw: Column) -> Column:
    # The two common forms need no rewriting.
    usual = F.when(raw.rlike(_USUAL), _try(F.substring_index(raw, ", ", -1), _SHAPES[0][1]))
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(raw))
    return F.coalesce(usual, iso, bound(_rewritten(raw), _shaped))


def _rewritten(raw: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(raw, _COMMENT, ""), _WEEKDAY, "")
    text = F.regexp_replace(text, _FRACTION, "$1")
    text = F.regexp_replace(text, _UTC_NAME, " +0000")
    text = F.regexp_replace(text, _OTHER_ZONE, "")
    return F.regexp_replace(text, _COLON_OFFSET, "$1$2")


def _shaped(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(shape), _try(text, pattern)) for shape, pattern in _SHAPES])


def _try(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def utc_midnight(day: str | None) -> dt.datetime | None:
    """`YYYY-MM-DD` as an instant, for range bounds (C8); a bad text raises."""
    if day is None:
        return None
    return dt.datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=dt.timezone.utc)


def whole_seconds(value: Column) -> Column:
    """A decimal epoch cut to an integer."""
    return value.cast("long")


def object_path(ts: Column, article_id: Column) -> Column:
    """`year/month/day/id.json` without zero padding."""
    return F.concat(
        F.concat_ws("/", F.year(ts), F.month(ts), F.dayofmonth(ts), article_id), F.lit(".json")
    )


def utc_day(ts: Column) -> Column:
    """Calendar day of an instant (C17)."""
    return F.to_date(ts)


def iso_time(epoch: Column) -> Column:
    """Epoch seconds as ISO 8601 text in UTC."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss")
