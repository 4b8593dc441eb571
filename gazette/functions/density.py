"""The part of a page that reads like an article: blocks scored by words and links.

A page is cut at its block tags. A block is worth its words less twice those inside of
links, less a price that short blocks do not earn; its neighbours count half. The
article is the run of blocks that is worth most, so short paragraphs between long ones
stay and menus, lists of links and comments set apart by short blocks do not.
All of it is built-in columns over the array of a page's blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gazette.functions.html import squeezed, unescaped, without_tags

# What a block costs, in words.
PRICE = 6

_GONE = r"(?is)<(?:!--.*?-->|(script|style|noscript|form|nav|aside|footer|select|svg|template|head)\b.*?</\1\s*>)"
_CUT = (
    r"(?i)</?(?:p|div|h[1-6]|li|ul|ol|dl|dt|dd|table|tbody|thead|tr|td|th|section|article|main|header|body|html|"
    r"blockquote|pre|figure|figcaption|br|hr)(?:\s[^>]*)?/?>"
)
_LINK = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
_CUT_MARK = "\u0001"


def page_blocks(html: Column) -> Column:
    """A page's blocks in order: markup between block tags, without scripts, menus, forms and footers."""
    plain = F.replace(F.regexp_replace(html, _GONE, _CUT_MARK), F.lit(_CUT_MARK), F.lit("<br>"))
    return F.split(plain, _CUT)


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def block_values(blocks: Column) -> Column:
    """Worth of each block by itself, in words; a block without text is worth nothing."""
    def value(block: Column) -> Column:
        words = _words(without_tags(block))
        linked = _words(F.array_join(F.transform(
            F.regexp_extract_all(block, F.lit(_LINK), F.lit(1)), without_tags), " "))
        return F.when(words == 0, F.lit(0)).otherwise(words - 2 * linked - PRICE)

    return F.transform(blocks, value)


def smoothed(values: Column) -> Column:
    """Twice each value with one time its neighbours."""
    near = lambda i: F.coalesce(F.try_element_at(values, i), F.lit(0))
    return F.transform(values, lambda v, i: 2 * v + F.when(i > 0, near(i)).otherwise(F.lit(0)) + near(i + 2))


def best_run(values: Column) -> Column:
    """Struct of `total`, `start` and `end` (from 0, inclusive) of the run of values that is worth most.

    The first one of equal ends with the earliest start; total 0 where no run is worth anything.
    """
    zero = F.lit(0)
    state = F.struct(*[zero.alias(n) for n in ("total", "start", "end", "now", "since", "at")])

    def step(s: Column, v: Column) -> Column:
        goes_on = s["now"] >= 0
        now = F.when(goes_on, s["now"]).otherwise(zero) + v
        since = F.when(goes_on, s["since"]).otherwise(s["at"])
        better = now > s["total"]
        return F.struct(
            F.when(better, now).otherwise(s["total"]).alias("total"),
            F.when(better, since).otherwise(s["start"]).alias("start"),
            F.when(better, s["at"]).otherwise(s["end"]).alias("end"),
            now.alias("now"), since.alias("since"), (s["at"] + 1).alias("at"))

    return F.aggregate(values, state, step, lambda s: F.struct(s["total"].alias("total"), s["start"].alias("start"), s["end"].alias("end")))


def block_text(block: Column) -> Column:
    """A block's words with single spaces; null where it has none."""
    return squeezed(unescaped(without_tags(block)))
