"""Main texts of pages: golden pages, the style tree against brute force, awkward rows."""

import math
import random
from collections import defaultdict

import pytest

from gazette.llm import sitetree

SCHEMA = "page_id long, url string, html string, text string, n_chars string, Low string, site string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def texts(spark, rows):
    return sorted(((x.page_id, x.text, x.n_removed) for x in sitetree.extract(table(spark, rows)).collect()), key=str)


def main(page):
    return [b.text for b in sitetree.region(sitetree.blocks(page)[0])]


GOLDEN = [
    ("<nav><a href=/>Home</a></nav><article><h1>T &amp; t</h1><p>One\n two<br>three<p>Four</article><footer>f</footer>",
     ["T & t", "One two three", "Four"]),
    ("<body class='has-sidebar'><article><p>Kept</p><div class='ad-box'>Buy</div><aside>s</aside><form>f<input></form></article>", ["Kept"]),
    ("<article><header><h1>Head</h1></header><p>Text</p><footer>by me</footer></article><header>site</header>", ["Head", "Text"]),
    ("<article><p>The long article, many words.</p></article><div class=comments><article class=comment>hi</article></div>",
     ["The long article, many words."]),
    ("<article><p>A long first half of it.</p></article><article><p>And the second half.</p></article><article>x</article>",
     ["A long first half of it.", "And the second half."]),
    ("<div id=menu><a href=1>One</a></div><div id=content><p>In content</p>tail</div><div>other</div>", ["In content", "tail"]),
    ("<div><a href=1>A link</a> | <a href=2>More</a></div><p>Plain text without any marks</p>", ["Plain text without any marks"]),
    ("<main><p>a<b>b</b>c</p><pre> x \n y </pre><ul><li>1<li>2</ul><table><tr><td>3<td>4<tr><td>5</table></main>",
     ["abc", "x y", "1", "2", "3", "4", "5"]),
    ("<article><script>var t='</p><p>no';</script><style>p{}</style><!-- <p>no</p> --><noscript>no</noscript><p>yes</p></article>", ["yes"]),
    ("<article><p>&lt;b&gt; &#8364; &#x41; &nbsp; &unknown; &amp;amp; 5 < 6 &amp", ["<b> € A &unknown; &amp; 5 < 6 &"]),
    ("<article><p title='a>b'>one</p><p data-x=\"it's\">two</p><P CLASS=\"Cookie-Notice\">no</P></ARTICLE>", ["one", "two"]),
    ("<div role=navigation>n</div><div role=main><p hidden>h</p><p>text</p></div>", ["text"]),
    ("<article><p><b>Bold<br><p>Next</p><p><b>Open</article>", ["Bold", "Next", "Open"]),
    ("just text", ["just text"]),
    ("", []), ("<", ["<"]), ("<p", []), ("<article></article>", []), ("<!-- never closed <p>x</p>", []), ("</p></div>text", ["text"]),
]


@pytest.mark.parametrize("page, want", GOLDEN)
def test_golden(page, want):
    assert main(page) == want


def site_of(n, host="h.example", extra=""):
    r = random.Random(n)
    out = []
    for i in range(n):
        paragraphs = "".join(f"<p>Paragraph {r.random()} of page {i}.</p>" for _ in range(r.randint(1, 6)))
        out.append((i, f"https://{host}/p/{i}?x=1", f"<title>T{i}</title><article><h1>T{i}</h1>{paragraphs}"
                    f"<div class='x{i}'><p>Get our daily letter.</p></div>{extra}</article>"))
    return out


def test_what_a_site_repeats_is_removed(spark):
    rows = site_of(20)
    found = {i: (t, n) for i, t, n in texts(spark, rows)}
    for i, _, html in rows:
        want = [b.text for b in sitetree.region(sitetree.blocks(html)[0])]
        assert found[i] == ("\n".join(x for x in want if x != "Get our daily letter."), 1)
    # a host of few pages shows nothing; so does a page without a host
    few = site_of(sitetree.MIN_PAGES - 1, "few.example")
    assert all(n == 0 and "daily letter" in t for _, t, n in texts(spark, few))
    assert all(n == 0 for _, _, n in texts(spark, [(i, "no address", h) for i, _, h in rows]))


def test_copies_of_one_article_stay(spark):
    page = "<title>One</title><article><h1>One</h1><p>The same text everywhere.</p></article>"
    rows = [(i, f"http://h.example/{i}", page) for i in range(40)]
    rows += [(100 + i, f"http://h.example/x{i}", f"<title>O{i}</title><article><h1>O{i}</h1><p>Text {i}</p></article>") for i in range(10)]
    assert all(n == 0 for _, _, n in texts(spark, rows))


def test_importances_are_those_of_the_definition(spark):
    rows = site_of(13, "a.example", "<p>Shared by all</p>") + site_of(9, "b.example")
    rows += [(500 + i, "http://a.example/q", f"<title>Q{i}</title><article><p>Shared by all</p><p>Q{i}</p></article>") for i in range(4)]
    pages = defaultdict(lambda: defaultdict(set))
    shown = defaultdict(lambda: defaultdict(set))
    styles = defaultdict(lambda: defaultdict(set))
    for _, url, html in rows:
        found, title = sitetree.blocks(html)
        site = url.split("/")[2]
        for b in sitetree.region(found):
            pages[site, b.node]["m"].add(title)
            shown[site, b.node][b.value].add(title)
            styles[site, b.node][b.style].add(title)
    want = []
    for key, values in shown.items():
        m = len(pages[key]["m"])
        shares = [len(t) / m for t in styles[key].values()]
        for t in values.values():
            if m > 1 and len(t) > 1:
                want.append((m, len(t), round(-sum(p * math.log(p, m) for p in shares), 9), round(1 - math.log(len(t), m), 9)))
    got = [(x.m, x.n, round(x.presentation, 9), round(x.content, 9)) for x in sitetree.style_tree(table(spark, rows)).collect()]
    assert sorted(got) == sorted(want) and want


def test_furniture_has_blocks_of_its_own():
    page = ("<head><title>T</title><script>no()</script></head><nav>m<ul><li><a href=1>Home</a><li>x &amp; y</ul>tail</nav>"
            "<article><p>a<button>Buy <b>it</b><br></button>b<span hidden>h</span>c</p></article><footer><a href=2>f</a></footer>end")
    found, title = sitetree.blocks(page)
    assert title == "T"
    assert [b.text for b in found if b.furniture] == ["m", "Home", "x & y", "tail", "Buy it", "h", "f"]
    assert [b.text for b in found if not b.furniture] == ["a bc", "end"] and main(page) == ["a bc"]
    by = {b.text: b for b in found}
    assert by["m"].node == by["tail"].node and by["Home"].node == by["x & y"].node != by["m"].node
    assert [by[x].links for x in ("Home", "f", "m", "end")] == [4, 1, 0, 0]
    assert [by[x].n_children for x in ("Home", "Buy it", "a bc")] == [1, 2, 0]
    assert main("<p>x</p>") and all(b.furniture for b in sitetree.blocks("<nav>a<p>b</nav><aside>c")[0])


def test_the_tree_has_the_whole_page(spark):
    rows = [(i, f"http://h.example/{i}", f"<title>T{i}</title><nav><a href=/>Home</a></nav><div class=ad>Buy {i % 3}</div>"
             f"<article><p>Text {i}</p></article><p>Beside</p><footer>f {i}</footer>") for i in range(12)]
    got = sorted((x.m, x.n, round(x.content, 9)) for x in sitetree.style_tree(table(spark, rows)).collect())
    one = (12, 12, 0.0)
    assert got == sorted([one, one] + [(12, 4, round(1 - math.log(4, 12), 9))] * 3)
    assert texts(spark, rows) == sorted(((i, f"Text {i}", 0) for i, _, _ in rows), key=str)


def test_the_article_is_chosen_without_what_a_site_repeats(spark):
    legal = "The same long legal text stands on every page. " * 20
    rows = [(i, f"http://h.example/{i}", f"<title>T{i}</title><div class='legal content'><p>{legal}</p></div>"
             f"<div class='post'><p>Post {i}</p></div>") for i in range(12)]
    assert texts(spark, rows) == sorted(((i, f"Post {i}", 0) for i, _, _ in rows), key=str)
    # an article that is all repeated stays empty: what stands beside it is not the article
    rows = [(i, u, f"<title>T{i}</title><article><p>Gone</p></article><p>Beside {i}</p>") for i, u, _ in rows]
    assert texts(spark, rows) == sorted(((i, "", 1) for i, _, _ in rows), key=str)


def test_awkward(spark):
    long = "<article>" + "".join(f"<p>{'word ' * 50}{i}</p>" for i in range(20_000)) + "</article>"
    rows = [(None, None, None), (1, None, ""), (2, "http://x.example/", None), (3, "", "<p>x</p>"), (3, "", "<p>x</p>"),
            (4, "http://x.example/", long), (None, "http://x.example/", "<p>no id</p>")]
    want = [(None, "", 0), (1, "", 0), (2, "", 0), (3, "x", 0), (3, "x", 0), (4, "\n".join(main(long)), 0), (None, "no id", 0)]
    assert texts(spark, rows) == sorted(want, key=str)
    assert texts(spark, []) == []
