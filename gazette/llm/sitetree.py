r"""Main text of pages by a site style tree: what a host repeats on its pages is not the article.

The pages of one host are merged into one tree: a block stands at the path of its tags and
classes (digits left out). A node's presentation is the sequence of its child elements, its
content the text and links of a block. Over the m pages that have a node (pages of one
title count once, so copies of an article do not make it look like boilerplate)

    presentation importance = -sum p log_m p   over the shares p of its presentations
    content importance      = 1 - log_m n      for content that n of the pages show

and a block's importance weighs the two by its number l of child elements, with 0.9**l for
the content. Varied presentation and content seen once are important; what nearly all
pages show alike is not. Blocks with content and whole below LEAST are removed from the
page, on hosts with at least MIN_PAGES pages; a branch all of whose blocks go is gone.
The tree has every block of a page: menus, adverts and footers too.

A host of few pages shows nothing, and text drawn from a pool of menus or adverts varies
as an article does. Elements whose tag, role or class says what they are (FURNITURE) are
therefore removed as well, whatever the tree says of them, and the rest is narrowed to the
article, lengths without what the tree removed: the longest `article` and others at least a
third as long; else a `main` or content element; else the body without blocks that are
mostly links. An element of furniture inside a block of the article is a block beside it.

Statistics are hashes of all blocks, counted by Spark; the pages themselves are read twice and not moved,
unless the removable blocks of all sites outgrow what Spark broadcasts by itself.

Rows: one for each page, repeated ones too. Null or empty html has an empty text; null urls
and urls without a host form no site. Unclosed elements end with their parent, unknown
entities stay as they are; very long pages are read whole.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import in_arrow, kept, pick

LEAST = 0.1
MIN_PAGES = 8
WEIGHT = 0.9

# Elements and attributes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: A start tag ends these open elements, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: What holds a paragraph open inside it: its text is not that of the paragraph outside.
_HOLDS = frozenset("td th table button object caption".split())

# What is not the article, by tag, role and class.
FURNITURE = frozenset(
    "aside button canvas datalist dialog embed footer form head iframe input menu nav noembed noframes noscript object "
    "script search select style svg template textarea title xmp".split())
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
FURNITURE_CLASSES = frozenset(
    "ad ads advert advertisement advertisements advertising adverts alert banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies discussion disqus footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promotion recommended related replies respond "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
#: Outside an article only: an article has a header of its own.
PAGE_FURNITURE = frozenset({"header"})
CONTENT_CLASSES = frozenset("article articlebody content entry main maincontent post story".split())
_NOT_ITSELF = frozenset("has no with without".split())

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKEN = re.compile(r"[a-z0-9]+")
_DIGITS = re.compile(r"[0-9]+")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), entities.unescape("".join(values)))
    return found


def _says(attributes: dict[str, str]) -> set[str]:
    """The words of class and id; of has-sidebar and the like, none."""
    out: set[str] = set()
    for name in ("class", "id"):
        for one in attributes.get(name, "").lower().split():
            tokens = _TOKEN.findall(one)
            if tokens and tokens[0] not in _NOT_ITSELF:
                out.update(tokens)
    return out


class _Element:
    """`block` is the block that its text belongs to; inside of furniture, `named` is."""

    __slots__ = ("tag", "node", "block", "named", "furniture", "article", "content", "link")

    def __init__(self, tag, node, block, named, furniture, article, content, link):
        self.tag, self.node, self.block, self.named, self.furniture = tag, node, block, named, furniture
        self.article, self.content, self.link = article, content, link


class _Run:
    """What a block has shown so far: texts, characters in links, child elements, targets of links and images."""

    __slots__ = ("held", "linked", "children", "refs")

    def __init__(self):
        self.held, self.linked, self.children, self.refs = [], 0, [], []


class Block:
    """One block's text, with the node it stands at and what it lies in."""

    __slots__ = ("node", "text", "links", "n_children", "style", "furniture", "article", "content", "value")

    def __init__(self, node, text, run, furniture, article, content):
        self.node, self.text, self.links, self.furniture = node, text, run.linked, furniture
        self.article, self.content = article, content
        children, refs = run.children, run.refs
        self.n_children = len(children)
        self.style = xxhash.xxh3_64_intdigest(" ".join(children))
        self.value = xxhash.xxh3_64_intdigest(text + "\0" + "\0".join(refs))


def blocks(page: str) -> tuple[list[Block], str]:
    """The blocks with text, in order, and the page's title.

    Of each block, the text outside of furniture; furniture has blocks of its own.
    """
    root = _Element("#", 0, 0, None, False, -1, 0, False)
    root.block = root
    stack, out, title = [root], [], ""
    shown, named = _Run(), _Run()
    n_articles, n_contents = 0, 0

    def ended(run: _Run, at: _Element, block: _Element, furniture: bool) -> None:
        if run.held:
            text = " ".join(entities.unescape("".join(run.held)).split())
            if text:
                out.append(Block(block.node, text, run, furniture, at.article, at.content))
        run.held, run.linked, run.children, run.refs = [], 0, [], []

    def flush(at: _Element) -> None:
        ended(shown, at, at.block, False)
        if at.named:
            ended(named, at, at.named, True)

    def close(to: int) -> None:
        if any(e.block is e for e in stack[to:]):
            flush(stack[-1])
        elif any(e.named is e for e in stack[to:]):
            ended(named, stack[-1], stack[-1].named, True)
        del stack[to:]

    at, n = 0, len(page)
    while at <= n:
        found = _TAG.search(page, at)
        top = stack[-1]
        text = page[at:found.start() if found else n]
        if text:
            run = named if top.furniture else shown
            run.held.append(text)
            if top.link:
                run.linked += len(text.strip())
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                shown.held.append(" ")
                if top.furniture:
                    named.held.append(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in BLOCKS:
                    break
            continue
        if tag in BLOCKS:
            # a block ends the paragraph before it, and elements of a kind end each other
            ends, stop = ENDS.get(tag, ((), ()))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                elif stack[i].tag in stop:
                    break
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in _HOLDS:
                    break
            flush(stack[-1])
            top = stack[-1]
        attributes = _attributes(found[3]) if found[3].strip(" /") else {}
        if tag in ("a", "img"):
            (named if top.furniture else shown).refs.append(attributes.get("href") or attributes.get("src") or "")
        if tag == "br":
            shown.held.append(" ")
            if top.furniture:
                named.held.append(" ")
        says = _says(attributes) if attributes else set()
        roles = set(attributes.get("role", "").lower().split())
        furniture = top.furniture
        if not furniture and tag not in ("html", "body", "main"):
            furniture = (
                tag in FURNITURE or bool(roles & FURNITURE_ROLES) or bool(says & FURNITURE_CLASSES) or "hidden" in attributes
                or tag in PAGE_FURNITURE and top.article < 0)
        if tag not in BLOCKS:
            if top.furniture:
                named.children.append(tag)
            elif not furniture:
                shown.children.append(tag)
        if tag in VOID:
            continue
        article, content = top.article, top.content
        if not furniture:
            if article < 0 and (tag == "article" or "article" in roles):
                article, n_articles = n_articles, n_articles + 1
            if not content and (tag == "main" or "main" in roles or says & CONTENT_CLASSES
                                or attributes.get("itemprop", "").lower() == "articlebody"):
                n_contents += 1
                content = n_contents
        kind = _DIGITS.sub("", attributes.get("class", "")) if attributes else ""
        new = _Element(tag, xxhash.xxh3_64_intdigest(f"{top.node}\0{tag}\0{kind}"), None, None, furniture, article, content,
                       top.link or tag == "a")
        new.block = new if tag in BLOCKS else top.block
        if furniture:
            new.named = top.named if top.furniture and tag not in BLOCKS else new
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            if tag == "title" and not title:
                title = page[at:end.start() if end else n]
            if end:
                at = end.start()
            else:
                break
        stack.append(new)
    flush(stack[-1])
    return out, title


def region(found: list[Block], removed: frozenset[Block] = frozenset()) -> list[Block]:
    """The blocks of the article, or of what comes nearest to one by the length of all but `removed`."""
    found = [b for b in found if not b.furniture]
    size: dict[int, int] = {}
    for b in found:
        if b.article >= 0:
            size[b.article] = size.get(b.article, 0) + (0 if b in removed else len(b.text))
    if size:
        least = max(size.values()) / 3
        return [b for b in found if b.article >= 0 and size[b.article] >= least]
    for b in found:
        if b.content:
            size[b.content] = size.get(b.content, 0) + (0 if b in removed else len(b.text))
    if size:
        longest = max(size, key=lambda k: (size[k], -k))
        return [b for b in found if b.content == longest]
    return [b for b in found if 2 * b.links <= len(b.text)]


_STATS = "site bigint, node bigint, kind int, value bigint, title bigint"
_PRESENT, _STYLE, _CONTENT = 0, 1, 2


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page shows at each node, once a page."""
    for batch in batches:
        out: list[tuple] = []
        for site, page in zip(batch.column("site").to_pylist(), batch.column("html").to_pylist()):
            if site is None or not page:
                continue
            found, title = blocks(page)
            key = _signed(xxhash.xxh3_64_intdigest(title or next((b.text for b in found if not b.furniture), "")))
            seen: set[tuple] = set()
            for b in found:
                seen.update(((b.node, _PRESENT, 0), (b.node, _STYLE, b.style), (b.node, _CONTENT, b.value)))
            out.extend((site, _signed(node), kind, _signed(value), key) for node, kind, value in seen)
            if len(out) > 50_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    site, node, kind, value, title = zip(*out)
    return pa.record_batch({
        "site": pa.array(site, pa.int64()), "node": pa.array(node, pa.int64()), "kind": pa.array(kind, pa.int32()),
        "value": pa.array(value, pa.int64()), "title": pa.array(title, pa.int64())})


def host(url: Column) -> Column:
    """The host of an address, lower-case; null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def with_site(pages: DataFrame) -> DataFrame:
    rows = pick(pages, page_id="long", url="string", html="string")
    return rows.withColumn("site", F.when(host(F.col("url")).isNotNull(), F.xxhash64(host(F.col("url")))))


def style_tree(pages: DataFrame) -> DataFrame:
    """The sites' trees: (site, node, value, m, n, presentation, content) for each content that several titles show.

    `value` is the content's hash; importances as above.
    """
    stats = in_arrow(with_site(pages).select("site", "html"), _statistics, _STATS)
    counts = kept(
        stats.distinct().groupBy("site", "node", "kind", "value").agg(F.count("*").alias("n"))
        .where((F.col("kind") < _CONTENT) | (F.col("n") > 1)), "tree")
    node = ["site", "node"]
    present = counts.where(F.col("kind") == _PRESENT).where(F.col("n") > 1).select(*node, F.col("n").alias("m"))
    share = F.col("n") / F.col("m")
    styles = counts.where(F.col("kind") == _STYLE).join(present, node).groupBy(*node).agg(
        F.sum(-share * F.ln(share) / F.ln("m")).alias("presentation"))
    return counts.where(F.col("kind") == _CONTENT).join(present, node).join(styles, node).select(
        *node, "value", "m", "n", "presentation", (1 - F.ln("n") / F.ln("m")).alias("content"))


def _extracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url and text of each page without the blocks that its site lists as unimportant."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            some = batch.slice(start, 256)
            texts, removed = [], []
            for page, low in zip(some.column("html").to_pylist(), some.column("low").to_pylist()):
                every = blocks(page)[0] if page else []
                gone = frozenset()
                if low:
                    known = {(x["node"], x["value"]): (x["presentation"], x["content"]) for x in low}
                    gone = frozenset(b for b in every if _unimportant(b, known))
                article = region(every, gone)
                left = [b for b in article if b not in gone]
                texts.append("\n".join(b.text for b in left))
                removed.append(len(article) - len(left))
            yield pa.record_batch({
                "page_id": some.column("page_id"), "url": some.column("url"), "text": pa.array(texts, pa.string()),
                "n_removed": pa.array(removed, pa.int64())})


def _unimportant(b: Block, known: dict) -> bool:
    """Whether content and block are both below LEAST."""
    found = known.get((_signed(b.node), _signed(b.value)))
    if not found:
        return False
    presentation, content = found
    part = math.pow(WEIGHT, b.n_children)
    return content < LEAST and (1 - part) * presentation + part * content < LEAST


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_removed (blocks that the site's tree took from the article) of every page."""
    low = kept(
        style_tree(pages).where((F.col("m") >= MIN_PAGES) & (F.col("content") < LEAST))
        .groupBy("site").agg(F.collect_list(F.struct("node", "value", "presentation", "content")).alias("low")), "low")
    return in_arrow(
        with_site(pages).join(low, "site", "left").select("page_id", "url", "html", "low"),
        _extracting, "page_id bigint, url string, text string, n_removed bigint")
