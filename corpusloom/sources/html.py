"""HTML to text, headings and links, on the standard library's event parser, a batch at a time."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no content, and fragments of class names of page furniture.
DROPPED_TAGS = frozenset(("nav", "header", "footer", "script", "style", "noscript"))
DROPPED_CLASSES = ("navbar", "nav", "footer", "header", "sidebar", "menu", "breadcrumb")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        """This element and all below it, in document order; no recursion, so nesting may be deep."""
        stack = [self]
        while stack:
            x = stack.pop()
            yield x
            stack += [c for c in reversed(x.children) if isinstance(c, Node)]

    def strings(self) -> list[str]:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                stack += reversed(x.children)
        return out


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _prune(root: Node) -> None:
    def dropped(n: Node) -> bool:
        return n.tag in DROPPED_TAGS or any(x in n.attrs.get("class", "").lower() for x in DROPPED_CLASSES)

    for node in root.walk():
        if any(isinstance(c, Node) and dropped(c) for c in node.children):
            node.children = [c for c in node.children if not (isinstance(c, Node) and dropped(c))]


def page_text(html: str) -> tuple[str, list[str]]:
    """(text, headings): the body's text nodes, one line each, without blanks; h1-h3 with text. No body: both empty."""
    root = parse(html)
    _prune(root)
    headings, body = [], None
    for n in root.walk():
        if n.tag in ("h1", "h2", "h3"):
            t = "".join(s.strip() for s in n.strings())
            if t:
                headings.append(t)
        elif n.tag == "body" and body is None:
            body = n
    if body is None:
        return "", []
    lines = [x.strip() for x in "\n".join(body.strings()).splitlines()]
    return "\n".join(x for x in lines if x), headings


def _hrefs(html: str) -> list[str]:
    return [n.attrs["href"] for n in parse(html).walk() if n.tag == "a" and n.attrs.get("href")]


def index_links(html: str, base: str) -> list[str]:
    """Absolute links to index pages below ``base``, in order, repeats kept."""
    links = [urljoin(base, h) for h in _hrefs(html) if h.endswith(("/index.htm", "/index.html"))]
    return [x for x in links if base in x]


def chapter_links(html: str, base: str) -> list[str]:
    """Absolute links to pages below ``base`` that are no index pages."""
    links = [urljoin(base, h) for h in _hrefs(html) if h.endswith((".htm", ".html")) and "index" not in h]
    return [x for x in links if base in x]


def search_results(html: str) -> list[tuple[str, str, str]]:
    """(book id, title, author) of the entries of a result page."""
    out = []
    has = lambda n, tag, cls: n.tag == tag and cls in n.attrs.get("class", "").split()
    for item in parse(html).walk():
        if not has(item, "li", "booklink"):
            continue
        link = next((n for n in item.walk() if has(n, "a", "link")), None)
        if link is None or not link.attrs.get("href"):
            continue
        author = next((n for n in item.walk() if has(n, "span", "subtitle")), None)
        text = lambda n: "".join(s.strip() for s in n.strings())
        out.append((link.attrs["href"].strip("/").rsplit("/", 1)[-1], text(link), text(author) if author is not None else "unknown"))
    return out


@F.pandas_udf(StructType([StructField("text", StringType()), StructField("chapters", ArrayType(StringType()))]))
def html_page(html: pd.Series) -> pd.DataFrame:
    rows = [page_text(h) if h is not None else (None, None) for h in html]
    return pd.DataFrame(rows, columns=["text", "chapters"])


def _links_udf(f):
    @F.pandas_udf(ArrayType(StringType()))
    def links(html: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([f(h, b) if h is not None and b is not None else [] for h, b in zip(html, base)])

    return links


tradition_links = _links_udf(index_links)
book_links = _links_udf(chapter_links)


def book_links_or_self(html: Column, base: Column) -> Column:
    """The chapters of a book, or the book's own page if it lists none."""
    links = book_links(html, base)
    return F.when(F.size(links) > 0, links).otherwise(F.array(base))


@F.pandas_udf(ArrayType(StructType([StructField(c, StringType()) for c in ("ebook_id", "title", "author")])))
def result_entries(html: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("ebook_id", "title", "author"), r)) for r in search_results(h)] if h is not None else [] for h in html])


def url_to_id(tradition: Column, url: Column) -> Column:
    """tradition / path of the URL, with underscores for its slashes."""
    return F.concat(tradition, F.lit("/"), F.replace(F.trim(F.parse_url(url, F.lit("PATH")), F.lit("/")), F.lit("/"), F.lit("_")))


def headings_fast(html: Column) -> Column:
    """Headings of well-formed pages without inner tags, in the JVM."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3][^>]*>([^<]*)</h[1-3]>"), F.lit(1))
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")
