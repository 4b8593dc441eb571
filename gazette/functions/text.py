"""Keys, text cleaning and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gazette.schemas import KEY_LENGTH, NA_TOKENS

# Fixed value: what counts as an url in running text. `(?U)` and the extra
# control characters make Java's idea of white space the Unicode one.
URL_PATTERN = r"(?U)http[^\s\x1c-\x1f]+|www[^\s\x1c-\x1f]+"


def key_of(text: Column, length: int = KEY_LENGTH) -> Column:
    """First `length` hex characters of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(text, 256), 1, length)


def without_newlines(text: Column) -> Column:
    """Newlines are removed, not replaced: the words around them join."""
    return F.replace(text, F.lit("\n"), F.lit(""))


def without_urls(text: Column) -> Column:
    """Urls are removed, the spaces around them stay."""
    return F.regexp_replace(text, URL_PATTERN, "")


def cleaned(text: Column) -> Column:
    """Newlines first, then urls (C4); null stays null.

    The order matters: an url at the end of a line also takes the first word of
    the next one.
    """
    return without_urls(without_newlines(text))


def na_to_null(text: Column) -> Column:
    """Missing-value tokens of a CSV file become null."""
    return F.when(text.isin(NA_TOKENS), F.lit(None)).otherwise(text)


def na_strings_to_null(df: DataFrame) -> DataFrame:
    """`na_to_null` on every string column."""
    return df.select(
        *[
            na_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def text_or_empty(value: Column) -> Column:
    """The value as text, `""` where it is missing (C14)."""
    return F.coalesce(value.cast("string"), F.lit(""))
