"""The choice of an article's text among a page's blocks."""

import pytest
from pyspark.sql import functions as F

from gazette.functions.density import best_run
from gazette.sources.pages import main_texts

LONG = "This paragraph has quite a few words, enough to read like a part of an article."
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Section number {i}</a></li>" for i in range(12)) + "</ul>"

GOLDEN = [
    # a menu before and a list of links after the text
    (f"<body>{MENU}<h1>A headline of an article that is long enough</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>{MENU}</body>",
     f"A headline of an article that is long enough\n{LONG}\nShort.\n{LONG}"),
    # the longer one of two articles, set apart by a menu
    (f"<article><p>{LONG}</p></article>{MENU}<article><p>{LONG} One.</p><p>{LONG} Two.</p></article>", f"{LONG} One.\n{LONG} Two."),
    # comments behind a form and short lines
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><form><p>{LONG}</p></form><div>Reply</div><div>by</div><div>Ann</div><div>3 h</div>"
     "<div>Like</div><div>Share</div><div>Nice one</div>", f"{LONG}\n{LONG}"),
    (f"<script>var a = '<p>{LONG}</p>'</script><p>Caf&eacute; &amp; {LONG}<br>next line of it with several more words here</p>",
     f"Café & {LONG}\nnext line of it with several more words here"),
    ("<p>few words</p>", None), ("", None), (None, None), ("no markup " * 8, ("no markup " * 8).strip()),
]


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden(spark, n):
    html, want = GOLDEN[n]
    pages = spark.createDataFrame([("u", html, 1)], "url string, html string, score int").withColumnRenamed("score", "kept")
    row = main_texts(pages).head()
    assert row.content == want and row.kept == 1 and (row.score > 0) == (want is not None)


@pytest.mark.parametrize("values, want", [
    ([], (0, 0, 0)), ([-1, -2], (0, 0, 0)), ([3], (3, 0, 0)), ([1, -5, 4, -1, 2, -9, 3], (5, 2, 4)), ([0, 2, 0], (2, 0, 1)),
    ([2, -2, 2], (2, 0, 0)),
])
def test_best_run(spark, values, want):
    df = spark.createDataFrame([(values,)], "v array<int>").select(best_run(F.col("v")).alias("r"))
    assert tuple(df.head().r) == want
