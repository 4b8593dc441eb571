"""Title and text of a fetched page (S6) and character references."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

# Alternatives share their first character, so most positions fail at once.
_DROPPED_BLOCKS = (
    r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>"
    r'|nav\b.*?</nav\s*>|div class="ad">.*?</div\s*>)'
)
_TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
_HEADING = r"(?is)<h1[^>]*>(.*?)</h1\s*>"
_ARTICLE = r"(?is)<article[^>]*>(.*?)</article\s*>"
_BODY = r"(?is)<body[^>]*>(.*?)</body\s*>"
_TAG = r"<[^>]*>"
_AMPERSAND = r"&(?:amp|#0*38|#[xX]0*26);"
_SPACES = r"(?U)\s+"


def _named_references() -> Column:
    names = {n: chr(c) for n, c in name2codepoint.items() if n != "amp"}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _character(reference: Column) -> Column:
    """The character of a numeric reference body, `233` or `xE9`."""
    code = F.when(
        F.lower(reference).startswith("x"),
        F.conv(F.substring(reference, 2, 8), 16, 10).cast("long"),
    ).otherwise(reference.cast("long"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(valid, text).otherwise(F.lit("�"))


def unescaped(text: Column) -> Column:
    """Character references become characters, each one once (`&amp;` goes last)."""
    named = _named_references()
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&([A-Za-z][A-Za-z0-9]*);"), F.lit(1)))
    out = F.aggregate(
        names, text,
        lambda acc, n: F.coalesce(
            F.replace(acc, F.concat(F.lit("&"), n, F.lit(";")), F.try_element_at(named, n)), acc
        ),
    )
    numbers = F.array_distinct(
        F.regexp_extract_all(text, F.lit(r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(1))
    )
    numbers = F.filter(numbers, lambda n: ~F.concat(F.lit("&#"), n, F.lit(";")).rlike(_AMPERSAND))
    out = F.aggregate(
        numbers, out,
        lambda acc, n: F.replace(acc, F.concat(F.lit("&#"), n, F.lit(";")), _character(n)),
    )
    out = F.regexp_replace(out, _AMPERSAND, "&")
    return F.when(text.contains("&"), out).otherwise(text)


def first_part(content: Column, pattern: str) -> Column:
    """The pattern's group where it first matches, else null."""
    return F.nullif(F.regexp_extract(content, pattern, 1), F.lit(""))


def without_blocks(html: Column) -> Column:
    """The page without comments, scripts, styles, navigation and advertisements."""
    return F.regexp_replace(html, _DROPPED_BLOCKS, " ")


def title_markup(content: Column) -> Column:
    """Inside of `<title>`, else of the first `<h1>`; null where there is neither."""
    title = F.regexp_extract(content, _TITLE, 1)
    return F.coalesce(F.when(title.rlike(r"\S"), title), first_part(content, _HEADING))


def text_markup(content: Column) -> Column:
    """Inside of `<article>`, else of `<body>`; null where there is neither."""
    return F.coalesce(first_part(content, _ARTICLE), first_part(content, _BODY))


def without_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, _TAG, " ")


def squeezed(text: Column) -> Column:
    """Every run of white space one space, none at the ends; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(text, _SPACES, " ")), F.lit(""))
