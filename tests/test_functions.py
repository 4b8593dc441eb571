"""Golden cases of the column functions (FIXTURES.md §3)."""

import hashlib
import html as html_lib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gazette.functions import bodies, dates, html, text
from gazette.schemas import NA_TOKENS
from gazette.sources.pages import extract_articles

NOW = 1731000000


def column(spark, values, make):
    """`make` over a string column of the values, in order."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, v string")
    return [r["out"] for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


def test_key(spark):
    values = ["https://a.example/x", "", "é日本", None]
    want = [hashlib.sha256(v.encode()).hexdigest()[:10] if v is not None else None for v in values]
    assert column(spark, values, text.key_of) == want
    assert want[0] == "39021306bf"


def test_clean(spark):
    cases = {
        "a\nb http://x.y/z c www.q.r tail": "ab  c  tail",
        "see http://x.y/z\nNext word": "see  word",
        "a\r\nb": "a\rb",
        "httpd wwwx": " ",
        "one\x1chttp://a\x1dtwo": "one\x1c\x1dtwo",
        None: None,
    }
    assert column(spark, list(cases), text.cleaned) == list(cases.values())


def test_clean_agrees_with_python_whitespace(spark):
    """Every white space character of Python's `\\S` ends an url."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 10]
    values = [f"a http://x{s}b www{s}c" for s in spaces]
    pattern = re.compile(r"http\S+|www\S+")
    assert column(spark, values, text.cleaned) == [pattern.sub("", v) for v in values]


def test_na_tokens(spark):
    assert column(spark, [*NA_TOKENS, "x", " ", "na", None], text.na_to_null) == [None] * 19 + ["x", " ", "na", None]


PUBLISHED = {
    "Mon, 18 Nov 2024 10:11:12 +0000": 1731924672,
    "Tue, 18 Nov 2024 10:11:12 +0100": 1731921072,
    "Mon, 18 Nov 2024 10:11:12 +01:00": 1731921072,
    "Mon, 18 Nov 2024 10:11:12 Z": 1731924672,
    "2024-11-18T10:11:12Z": 1731924672,
    "Mon, 18 Nov 2024 10:11:12 GMT": 1731924672,
    "Mon, 18 Nov 2024 10:11:12 EST": 1731924672,
    "Mon, 18 Nov 2024 10:11:12": 1731924672,
    "18 Nov 2024 10:11 +0000": 1731924660,
    "Mon, 18 Nov 24 10:11:12 +0000": 1731924672,
    "  Mon, 18 Nov 2024 10:11:12 +0000": 1731924672,
    "2024-11-18T10:11:12.500Z": 1731924672,
    "2024-11-18T10:11:12+02:00": 1731917472,
    "2024-11-18": 1731888000,
    "November 18, 2024": 1731888000,
    "11/18/2024 10:11 AM": 1731924660,
    "03/04/2024": 1709510400,
    "": NOW, "yesterday": NOW, "2024-13-45": NOW, "1700000000": NOW, None: NOW,
}


def test_publish_date(spark):
    got = column(spark, list(PUBLISHED), lambda c: dates.publish_epoch(c, NOW))
    assert dict(zip(PUBLISHED, got)) == PUBLISHED


def test_object_path(spark):
    df = spark.sql("SELECT timestamp'2024-11-07 23:59:59' AS ts, 'abc' AS id")
    assert df.select(dates.object_path(F.col("ts"), F.col("id"))).first()[0] == "2024/11/7/abc.json"


def test_utc_midnight():
    assert dates.utc_midnight("2024-11-17").timestamp() == 1731801600
    assert dates.utc_midnight(None) is None
    with pytest.raises(ValueError):
        dates.utc_midnight("17.11.2024")


def test_message_round_trip(spark):
    df = spark.createDataFrame([("a\"b", 5), ("c", None)], "url string, dt bigint")
    rows = df.select(bodies.message_body(F.col("url"), F.col("dt")).alias("body"))
    assert [r[0] for r in rows.collect()] == ['{"u":"a\\"b","dt":5}', '{"u":"c","dt":null}']
    back = rows.select(bodies.decoded(F.col("body")).alias("m")).select("m.*")
    assert [tuple(r) for r in back.collect()] == [('a"b', 5), ("c", None)]


def test_undecodable_messages(spark):
    values = ['{"u": "a"', "3", '"x"', "[1]", "", None, '{"u": "a", "dt": "soon"}']
    assert column(spark, values, lambda c: bodies.decoded(c).isNull()) == [True] * 7


def test_body_rows(spark):
    values = ['{"a": 1}', '[{"a": 1}, {"a": 2}]', "{bad", "3", '[{"a": 1}, 3]', "[]", None]
    got = column(spark, values, lambda c: bodies.body_rows(c, "a bigint"))
    assert [None if rows is None else [r["a"] for r in rows] for rows in got] == [
        [1], [1, 2], None, None, None, [], None
    ]


def test_character_references(spark):
    values = [
        "R&#233;sum&#xE9; &amp;lt; &lt;b&gt; &eacute;&copy;&nosuch; &#128512;", "no reference", "&#55296;",
        "&#38;lt;", "&amp;#39;", None, "a & b &; &#; &#x;",
    ]
    want = [html_lib.unescape(v) if v else v for v in values]
    assert column(spark, values, html.unescaped) == want


def extracted(spark, *pages):
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(pages)], "url string, html string")
    return [(r["title"], r["content"]) for r in extract_articles(df).orderBy("url").collect()]


def test_page_extraction(spark):
    got = extracted(
        spark,
        "<html><head><title> A &amp;\n B </title><script>'</article>'</script></head><body><nav>menu</nav>"
        "<article><h1>H</h1><p>one<p>two<!-- <article>no</article> --><style>x</style>"
        "<div class=\"ad\">buy</div> three</article>after</body></html>",
        "<body><H1 class=x>Only <i>heading</i></H1>text</body>",
        "<title>  </title><h1>fallback</h1><p>no body",
        "plain", "", None,
    )
    assert got == [
        ("A & B", "H one two three"), ("Only heading", "Only heading text"), ("fallback", None),
        (None, None), (None, None), (None, None),
    ]


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.text(alphabet=st.sampled_from("htpw:/. \n\r\t ab "), max_size=30), min_size=1, max_size=40))
def test_clean_property(spark, values):
    """Any text: the same as the two steps in Python."""
    want = [re.sub(r"http\S+|www\S+", "", v.replace("\n", "")) for v in values]
    assert column(spark, values, text.cleaned) == want
