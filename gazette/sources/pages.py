"""Articles out of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gazette.functions.density import best_run, block_text, block_values, page_blocks, smoothed
from gazette.functions.html import (
    squeezed, text_markup, title_markup, unescaped, without_blocks, without_tags,
)
from gazette.sources.files import require_columns


def extract_articles(pages: DataFrame) -> DataFrame:
    """`url`, `title`, `content` of each page; a page without either keeps its row.

    Columns other than `html` are kept. Each step is a projection of its own, so
    that its result is computed once although the next step uses it repeatedly.
    """
    require_columns(pages, ["url", "html"], "pages")
    kept = [c for c in pages.columns if c != "html"]
    title, content = F.col("title"), F.col("content")
    return (
        pages.withColumn("html", without_blocks(F.col("html")))
        .select(*kept, title_markup(F.col("html")).alias("title"), text_markup(F.col("html")).alias("content"))
        .select(*kept, without_tags(title).alias("title"), without_tags(content).alias("content"))
        .select(*kept, unescaped(title).alias("title"), unescaped(content).alias("content"))
        .select(*kept, squeezed(title).alias("title"), squeezed(content).alias("content"))
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """`url`, `content`, `score` of each page: the run of blocks that reads like an article.

    For pages that do not mark their article. Blocks are joined by line breaks; a page
    without a run worth anything, or without html, has a null content and the score 0.
    """
    require_columns(pages, ["url", "html"], "pages")
    kept = [c for c in pages.columns if c != "html"]
    run = F.col("run")
    inside = F.slice("blocks", run["start"] + 1, run["end"] - run["start"] + 1)
    text = F.array_join(F.filter(F.transform(inside, block_text), lambda t: t.isNotNull()), "\n")
    return (
        pages.select(*kept, page_blocks(F.coalesce("html", F.lit(""))).alias("blocks"))
        .select(*kept, "blocks", block_values(F.col("blocks")).alias("values"))
        .select(*kept, "blocks", best_run(smoothed(F.col("values"))).alias("run"))
        .select(*kept, F.when(run["total"] > 0, text).alias("content"), run["total"].alias("score"))
    )
