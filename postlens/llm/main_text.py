"""Main text of web pages, with the templates of each host removed.

A page is parsed into elements. Every element with text has a hash of its subtree: tag, class and the subtrees and texts below. Spark counts, for
each host, the different contents that a hash stands beside: the article that it is in, or else all main text of its page. So copies of a page count once. A subtree beside
at least ``MIN_PAGES`` contents and ``SHARE`` of the contents of its host is a template; an article or main element never is. Templates of a host are few, since a page holds only so many subtrees, and go to the host's pages with a join. A
second pass deletes them, together with what its tag, role, class or id marks as navigation, header, footer, sidebar, notice,
advert, form, script, style or comments, and takes the text of the articles, or of the main part or the body where there is no article.

Within a block white space is one blank; blocks are joined by line ends in page order; <br> is white space. Character references are decoded.
Null and empty html gives an empty text. Repeated rows are extracted alike. A null URL is a host of
its own. Other columns of the pages are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.shared import ascii_lower, load, materialize, packed, session, text_or_empty

MIN_PAGES, SHARE = 5, 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that an open <p> ends before, and those that end an open one of their own kind.
ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "body", "html"}
ENDS_OWN = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table td th article section div main body html".split())
DROPPED = frozenset(
    "head title script style noscript template nav aside footer form button select textarea input iframe object embed svg canvas video audio menu "
    "dialog datalist map math".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status".split())
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion adsense adbox adunit banner cookie cookies "
    "consent gdpr notice notices notification alert newsletter subscribe subscription signup paywall sidebar sidebars aside menu menus nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer comment comments commentlist disqus respond replies share sharing social related "
    "recommended popup modal overlay toolbar widget widgets".split()
)
OUTSIDE = frozenset(("header", "masthead", "topbar"))


class Element:
    __slots__ = ("tag", "marks", "hidden", "role", "parts", "state")

    def __init__(self, tag: str, attrs: dict):
        self.tag = tag
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
        self.marks = frozenset("".join(c if c.isalnum() else " " for c in names).split()) if names != " " else frozenset()
        self.hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true"
        self.role = (attrs.get("role") or "").lower()
        self.parts: list = []
        self.state: tuple | None = None


class Tree(HTMLParser):
    """Elements of a page; ends that are missing are put where HTML implies them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]

    def close_to(self, tags: tuple, scopes: frozenset) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                del self.open[k:]
                return
            if tag in scopes:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_P:
            self.close_to(("p",), SCOPES)
        if tag in ENDS_OWN:
            self.close_to(ENDS_OWN[tag], SCOPES - frozenset(ENDS_OWN[tag]))
        element = Element(tag, dict(attrs))
        self.open[-1].parts.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of an unknown kind is a comment up to the next >."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else -1

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def parsed(html: str) -> Element:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def in_order(root: Element) -> list[Element]:
    """Elements, each after those that it holds; without recursion, for pages may nest deeply."""
    found, stack = [], [root]
    while stack:
        element = stack.pop()
        found.append(element)
        stack.extend(p for p in element.parts if isinstance(p, Element))
    return found[::-1]


def subtree_hashes(root: Element) -> None:
    """Sets each element's ``state``: (hash of its subtree, has text)."""
    for element in in_order(root):
        digest, worded = xxhash.xxh3_64(f"{element.tag} {' '.join(sorted(element.marks))}".encode()), False
        for part in element.parts:
            if isinstance(part, str):
                words = " ".join(part.split())
                if words:
                    digest.update(b"\x01" + words.encode(errors="surrogatepass"))
                    worded = True
            else:
                digest.update(b"\x02" + part.state[0].to_bytes(8, "little"))
                worded = worded or part.state[1]
        element.state = (digest.intdigest(), worded)


def contents(root: Element) -> tuple[set[int], set[tuple[int, int]]]:
    """Hashes of the page's contents, and (subtree, content beside it) of all block subtrees with text."""
    subtree_hashes(root)
    parts = main_parts(root, set())
    digest = xxhash.xxh3_64()
    for part in parts:
        digest.update(part.state[0].to_bytes(8, "little"))
    whole = digest.intdigest()
    articles = {id(part) for part in parts if part.tag == "article"}
    beside, found, stack = set(), set(), [(root, whole)]
    while stack:
        element, content = stack.pop()
        if id(element) in articles:
            content = element.state[0]
            beside.add(content)
        if element.state[1] and element.tag in BLOCKS and element.tag not in ("html", "body", "main", "article") and element.role != "main":
            found.add((element.state[0], content))
        stack.extend((p, content) for p in element.parts if isinstance(p, Element))
    return beside or {whole}, found


def dropped(element: Element, inside: bool) -> bool:
    if element.tag in DROPPED or element.hidden or element.role in ROLES or element.marks & MARKED:
        return element.tag not in ("html", "body", "main") or element.hidden
    return not inside and (element.tag == "header" or bool(element.marks & OUTSIDE) and element.tag not in ("html", "body", "main", "article"))


def main_parts(root: Element, templates: set[int]) -> list[Element]:
    """The outermost articles; else the main parts; else the whole."""
    articles, mains, stack = [], [], [root]
    while stack:
        element = stack.pop()
        if dropped(element, False) or (element.state and element.state[0] in templates):
            continue
        if element.tag == "article":
            articles.append(element)
            continue
        if element.tag == "main" or element.role == "main":
            mains.append(element)
        stack.extend(p for p in reversed(element.parts) if isinstance(p, Element))
    return articles or mains[:1] or [root]


def main_text(html: str, templates: set[int]) -> str:
    if not html:
        return ""
    root = parsed(html)
    if templates:
        subtree_hashes(root)
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        if words := "".join(line).split():
            blocks.append(" ".join(words))
        line.clear()

    for part in main_parts(root, templates):
        inside = part.tag in ("article", "main")
        stack: list = [part]
        while stack:
            item = stack.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                line.append(item)
            elif item.tag == "br":
                line.append(" ")
            elif item is not part and (dropped(item, inside) or (item.state and item.state[0] in templates)):
                line.append(" ")
            else:
                block = item.tag in BLOCKS
                if block:
                    end_block()
                    stack.append(None)
                stack.extend(reversed(item.parts))
        end_block()
    return "\n".join(blocks)


def host_templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(t_host, templates); pages: host, html. A host has 1 / share times the subtrees of a content at most."""
    out = pa.schema([("host", pa.string()), ("subtree", pa.int64()), ("content", pa.int64())])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict = {"host": [], "subtree": [], "content": []}
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                beside, found = contents(parsed(html)) if html else ((), ())
                rows["host"] += [host] * (len(beside) + len(found))
                rows["subtree"] += [None] * len(beside) + [h - (1 << 63) for h, _ in found]  # null: the content itself
                rows["content"] += [c - (1 << 63) for c in beside] + [c - (1 << 63) for _, c in found]
            yield packed(rows, out)

    different = pages.mapInArrow(hashes, "host string, subtree long, content long").distinct()
    counted = different.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter((F.col("n") >= min_pages) | F.col("subtree").isNull())
    counted = materialize(counted, "host-subtrees")
    sizes = counted.filter("subtree is null").select(F.col("host").alias("s_host"), F.col("n").alias("contents"))
    common = counted.filter("subtree is not null").join(sizes, F.col("host") == F.col("s_host"))
    return common.filter(F.col("n") >= share * F.col("contents")).groupBy(F.col("host").alias("t_host")).agg(F.collect_list("subtree").alias("templates"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = ascii_lower(F.regexp_extract(text_or_empty("url"), "://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), text_or_empty("html").alias("html"))
    known = host_templates(rows.select("host", "html"), min_pages, share)
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            templates = [{h + (1 << 63) for h in t or ()} for t in batch.column("templates").to_pylist()]
            texts = [main_text(h, t) for h, t in zip(batch.column("html").to_pylist(), templates, strict=True)]
            kept = {c: batch.column(c).to_pylist() for c in ("page_id", "url")}
            yield packed(kept | {"text": texts, "n_chars": [len(t) for t in texts]}, out)

    joined = rows.join(known, F.col("host") == F.col("t_host"), "left").select("page_id", "url", "html", "templates")
    return joined.mapInArrow(read, "page_id long, url string, text string, n_chars long")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    session(spark)
    return extract(load(spark, sf_dir, "pages"))


# For the given pages, whose articles hold only headings, paragraphs, bold text and line breaks.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&nbsp;", " "), ("&amp;", "&"))


def _decoded(column: str) -> str:
    for name, char in _ENTITIES:
        column = f"replace({column}, '{name}', '{char}')"
    return column


SQL = f"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS art FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(art, '<br>', ' ', 'g'), '</?(?:p|h1)>'),
        lambda x: trim(regexp_replace({_decoded("regexp_replace(x, '</?b>', '', 'g')")}, '\\s+', ' ', 'g'))) AS parts FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""
