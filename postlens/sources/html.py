"""Articles from stored HTML pages, under one of three extraction profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.dates import as_time

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    children: list = field(default_factory=list)

    def walk(self) -> Iterator["Node"]:
        """Elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        """Text pieces, each trimmed, joined without a space; scripts and styles left out."""
        parts, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item.strip())
            elif item is self or item.tag not in HIDDEN:
                stack.extend(reversed(item.children))
        return "".join(parts)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Tree(HTMLParser):
    """Nested elements as written; an end tag closes its nearest open element."""

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

    def handle_comment(self, data):
        self.open[-1].children.append(Node("!", {}))  # parts the texts around it

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of an unknown kind is a comment up to the next >."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else -1

    def handle_data(self, data):
        siblings = self.open[-1].children
        if siblings and isinstance(siblings[-1], str):
            siblings[-1] += data
        else:
            siblings.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


Match = Callable[[Node], bool]


def is_tag(*tags: str) -> Match:
    return lambda n: n.tag in tags


def has_class(name: str, tag: str | None = None) -> Match:
    return lambda n: name in n.classes() and (tag is None or n.tag == tag)


def class_contains(part: str) -> Match:
    return lambda n: part in n.attrs.get("class", "")


def first(node: Node | None, *matches: Match) -> Node | None:
    """First element of the first match that finds any."""
    for match in matches:
        for child in node.walk() if node else ():
            if match(child):
                return child
    return None


def _text(node: Node | None, default: str = "") -> str:
    return node.text() if node else default


# --- Fixed values: what each profile looks for, and its limits --------------
CONTAINERS = [
    is_tag("article"), has_class("article"), has_class("post"), has_class("news-item"),
    class_contains("article"), class_contains("post"),
]
TITLES = [is_tag("h1"), is_tag("h2"), is_tag("h3"), has_class("title"), class_contains("title")]
BODIES = [has_class("content"), has_class("excerpt"), has_class("summary"), is_tag("p")]
GENERIC_LIMIT, GENERIC_TITLE = 15, 10
BLOCK_LIMIT = 10
LIGHT_LIMIT, LIGHT_TITLE, LIGHT_TEXT = 5, 10, 500
PAGES = 64  # parsed at a time
ARTICLES = pa.schema(
    [("page_id", pa.int64()), ("position", pa.int32())]
    + [(name, pa.string()) for name in ("title", "content", "url", "source", "author", "category")]
)


def generic_articles(root: Node, site: str) -> Iterator[dict]:
    for container in CONTAINERS:
        elements = [n for n in root.walk() if container(n)]
        if elements:
            break
    for position, element in enumerate(elements[:GENERIC_LIMIT]):
        title = _text(first(element, *TITLES))
        if len(title) < GENERIC_TITLE:
            continue
        anchor = first(element, is_tag("a"))
        if anchor is not None and "href" not in anchor.attrs:
            continue
        link = anchor.attrs["href"] if anchor else ""
        if link and not link.startswith("http"):
            link = site.rstrip("/") + "/" + link.lstrip("/")
        yield dict(
            position=position, title=title, content=_text(first(element, *BODIES)), url=link,
            source=site_name(site), author=None, category="General",
        )


def block_articles(root: Node, site: str) -> Iterator[dict]:
    blocks = [n for n in root.walk() if has_class("post-block", "div")(n)]
    for position, block in enumerate(blocks[:BLOCK_LIMIT]):
        heading = first(block, has_class("post-block__title", "h2"))
        anchor = first(heading, is_tag("a"))
        if anchor is not None and "href" not in anchor.attrs:
            continue
        yield dict(
            position=position, title=_text(heading, "No title"),
            content=_text(first(block, has_class("post-block__content", "div"))),
            url=anchor.attrs["href"] if anchor else "", source="TechCrunch",
            author=_text(first(block, has_class("river-byline__authors", "div")), "Unknown"), category="Technology",
        )


def light_articles(root: Node, site: str) -> Iterator[dict]:
    found = [
        n for n in root.walk()
        if n.tag in ("article", "div") and any("article" in c.lower() for c in n.classes())
    ]
    for position, element in enumerate(found[:LIGHT_LIMIT]):
        heading = first(element, is_tag("h1", "h2", "h3"))
        title = _text(heading)
        if len(title) > LIGHT_TITLE:
            yield dict(
                position=position, title=title, content=element.text()[:LIGHT_TEXT], url=site,
                source=site_name(site), author=None, category=None,
            )


PROFILES = {"generic": generic_articles, "blocks": block_articles, "light": light_articles}


def site_name(url: str) -> str:
    """Host of a page, port included."""
    return url.partition("//")[2].partition("/")[0]


def _rows(batches: Iterator[pa.RecordBatch], extract: Callable[[Node, str], Iterator[dict]]) -> Iterator[pa.RecordBatch]:
    """The articles of Arrow batches, ``PAGES`` pages at a time: only their texts and trees are held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, PAGES):
            rows = []
            for page in batch.slice(start, PAGES).to_pylist():
                if page["html"] is not None:
                    articles = extract(parse(page["html"]), page["url"] or "")
                    rows += [{"page_id": page["page_id"], **article} for article in articles]
            yield pa.RecordBatch.from_pylist(rows, schema=ARTICLES)


def extract_articles(pages: DataFrame, as_of, profile: str = "generic") -> DataFrame:
    """Articles of each page row (page_id, url, html), several per page.

    Pages are parsed in Arrow batches where they lie; nothing is shuffled. A
    page that cannot be parsed gives no rows. ``ingest_seq`` numbers the articles
    in page order.
    """
    extract = PROFILES[profile]
    found = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        lambda batches: _rows(batches, extract),
        "page_id long, position int, title string, content string, url string, source string, author string, "
        "category string",
    )
    now = as_time(as_of)
    dated = found.withColumn("date", F.date_format(now, "yyyy-MM-dd HH:mm:ss")).withColumn("scraped_at", now)
    return dated.withColumn("ingest_seq", F.monotonically_increasing_id())
