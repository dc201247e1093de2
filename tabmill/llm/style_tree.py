"""Main text of web pages by a style tree of each host.

Pass one parses each page and lays its block elements over those of the other
pages of its host: elements with the same path of tags, classes and ids are
one node. A node's presentations are the sequences of its children, its
contents the texts under it, each with the number of different pages that have
it. Its importance is the larger of the two entropies, divided by that of
pages that are all different: a menu that is the same on all pages scores 0,
an article 1. Copies of a page count once, so a much copied article isn't
taken for a template. Nodes that enough pages have and that score low are
noise.

Pass two parses each page again and takes away the branches that are noise in
its host's tree or that the page itself declares to be (menus, footers,
adverts, comments and so on), unless such a branch holds most of the text that
is the page's own. Where a page declares an article or main element, the rest
of the page is not main text.

Counts are summed by (host, node, value) with partial sums on the map side, so
a host with most of the pages is shared by all tasks. Pages are never shuffled
unless the noise table is too large for Spark to broadcast.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import for_workers, staged

LEAST_PAGES = 10  # different pages of a host that a node needs before it is judged
LEAST_IMPORTANCE = 0.15

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Fixed values of the HTML language.
RAW = {"script", "style", "textarea", "title", "template", "noscript", "iframe", "svg", "math", "object", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
#: An opening tag of the key ends the open element of these names that is nearest, up to one of the others.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}

NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset", "label"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "form"}
#: Parts of a class or id name that declare a branch to be none of the article.
NOISE_WORDS = {
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "popup", "promo", "promoted", "related", "replies", "search", "share", "sharing", "sidebar", "signup", "skip",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
MAIN_TAGS, MAIN_ROLES = {"article", "main"}, {"article", "main"}


@dataclass
class Node:
    """A block element: its place in the style tree, the blocks under it, and what it declares itself to be."""

    tag: str
    key: int
    declared: str = ""
    first: int = 0
    last: int = 0
    children: list[int] = field(default_factory=list)
    inside: tuple[int, ...] = ()


@dataclass
class Page:
    """Blocks of text, the nodes in page order, and for each block the numbers of the nodes that it lies in."""

    blocks: list[str] = field(default_factory=list)
    within: list[tuple[int, ...]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)


def _declared(tag: str, attributes: dict[str, str], in_main: bool) -> str:
    role = attributes.get("role", "").lower()
    if tag in NOISE_TAGS or role in NOISE_ROLES or (tag == "header" and not in_main) or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return "noise"
    if tag in MAIN_TAGS or role in MAIN_ROLES:
        return "main"
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    words = {w.lower() for w in _TOKENS.findall(names)} if tag not in ("html", "body") else set()
    if words & NOISE_WORDS or ("header" in words and not in_main):
        return "noise"
    return ""


def parse(source: str) -> Page:
    """Block elements and blocks of text of a page, whatever state its markup is in."""
    page, text, open_ = Page(), [], []
    root = Node("", 0)
    stack: list[tuple[str, int]] = []  # tags of open elements; number of the node, -1 for inline ones

    def node() -> tuple[int, ...]:
        return tuple(n for _, n in stack if n >= 0)

    def flush() -> None:
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            page.blocks.append(joined)
            page.within.append(node())

    def close(n: int) -> None:
        while len(stack) > n:
            _, number = stack[-1]
            if number >= 0:
                flush()
                page.nodes[number].last = len(page.blocks)
            stack.pop()

    at = 0
    while at < len(source):
        m = _MARKUP.search(source, at)
        if not m:
            break
        if m.start() > at:
            text.append(html.unescape(source[at : m.start()]))
        at = m.end()
        slash, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            if tag in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if stack[k][0] in ("table", "article", "main", "body") and tag not in BLOCK:
                    break
            continue
        if tag in RAW and not rest.endswith("/"):
            if tag not in ("title",):
                text.append(" ")
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag in BLOCK:
            names, bounds = ENDS.get(tag, ({"p"}, {"table", "article", "main", "section", "div", "td", "li", "body"}))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in names or (stack[k][0] == "p" and tag not in ("td", "th", "tr")):
                    close(k)
                    break
                if stack[k][0] in bounds:
                    break
            flush()
        elif tag in ("br", "option"):
            text.append("\n")
        if tag in VOID:
            continue
        number = -1
        if tag in BLOCK or tag in NOISE_TAGS:
            flush()
            above = next((page.nodes[n] for _, n in reversed(stack) if n >= 0), root)
            attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(rest)} if rest else {}
            mark = f"{above.key:x}>{tag}.{attributes.get('class', '')}#{attributes.get('id', '') if not re.search('[0-9]', attributes.get('id', '')) else ''}"
            in_main = any(page.nodes[n].declared == "main" for _, n in stack if n >= 0)
            made = Node(tag, xxhash.xxh64_intdigest(mark.encode("utf-8", "surrogatepass")), _declared(tag, attributes, in_main), len(page.blocks))
            if not above.children or above.children[-1] != made.key:
                above.children.append(made.key)
            number = len(page.nodes)
            page.nodes.append(made)
        stack.append((tag, number))
    if at < len(source):
        text.append(html.unescape(source[at:]))
    flush()
    close(0)
    return page


def main_blocks(page: Page, noise: frozenset[int] = frozenset()) -> list[str]:
    """Blocks outside of all noise; where the page has a main element with text, those inside of it only.

    A declaration of noise is only a prior: it is void for a branch that holds
    most of the text that is the page's own, which is that of the main element
    where there is one.
    """
    own = []
    for at, within in enumerate(page.within):
        nodes = [page.nodes[n] for n in within]
        if not any(n.key in noise for n in nodes):
            own.append((at, within, any(n.declared == "main" for n in nodes), any(n.declared == "noise" for n in nodes)))
    # A main element inside of declared noise is the page's only if no other has text.
    scope = [x for x in own if x[2] and not x[3]] or [x for x in own if x[2]] or own
    held, total = defaultdict(int), 0
    for at, within, _, _ in scope:
        total += len(page.blocks[at])
        for n in within:
            held[n] += len(page.blocks[at])
    return [page.blocks[at] for at, within, _, _ in scope if all(page.nodes[n].declared != "noise" or 2 * held[n] > total for n in within)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def observations(page: Page) -> Iterator[tuple[int, int, int, int]]:
    """(page, node, presentation, content) hashes, one for each node of the page."""
    digest = lambda parts: xxhash.xxh64_intdigest("\n".join(parts).encode("utf-8", "surrogatepass"))
    whole = digest(main_blocks(page))
    styles, contents = defaultdict(list), defaultdict(list)
    for node in page.nodes:
        styles[node.key].append(",".join(f"{c:x}" for c in node.children))
        contents[node.key].append("\n".join(page.blocks[node.first : node.last]))
    for key, style in styles.items():
        yield _signed(whole), _signed(key), _signed(digest(style)), _signed(digest(contents[key]))


def _hosts(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host.alias("host"))


def importance(pages: DataFrame) -> DataFrame:
    """(host, node, pages, presentation, content) over `pages` (host, html); entropies from 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "page", "node", "style", "content"]
        for batch in batches:
            rows = [(host, *x) for host, source in zip(batch.column(0).to_pylist(), batch.column(1)) for x in observations(parse(source.as_py()))]
            if rows:
                columns = list(zip(*rows))
                yield pa.record_batch([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names)

    seen = for_workers(pages.select("host", "html")).mapInArrow(run, "host string, page long, node long, style long, content long")
    once = staged(seen.groupBy("host", "node", "page").agg(F.min("style").alias("style"), F.min("content").alias("content")), "style-nodes")
    out = None
    for kind, name in (("style", "presentation"), ("content", "content")):
        counts = once.groupBy("host", "node", kind).agg(F.count(F.lit(1)).alias("n"))
        of = counts.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
        entropy = F.when(F.col("pages") > 1, 1 - F.col("nlogn") / F.col("pages") / F.log("pages")).otherwise(1.0)
        of = of.select("host", "node", *["pages"] * (out is None), entropy.alias(name))
        out = of if out is None else out.join(of, ["host", "node"])
    return out


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """One row for each row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    Cases: null and empty html give the empty string; a null or odd url stands
    for the host of no name; unclosed and stray markup is closed as browsers
    do, roughly; repeated rows give repeated rows; an empty table gives no rows;
    further columns are ignored.
    """
    hosts = _hosts(pages)
    judged = importance(hosts).where((F.col("pages") >= least_pages) & (F.greatest("presentation", "content") < least))
    noise = staged(judged.groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("noise")), "style-noise")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple, frozenset[int]] = {}
            texts = []
            for source, nodes in zip(batch.column(2), batch.column(3)):
                nodes = tuple(nodes.as_py() or ())
                if nodes not in known:
                    known[nodes] = frozenset(x & (1 << 64) - 1 for x in nodes)
                texts.append("\n".join(main_blocks(parse(source.as_py()), known[nodes])))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = hosts.join(noise, "host", "left").select("page_id", "url", "html", "noise")
    return for_workers(joined).mapInArrow(run, "page_id long, url string, text string, n_chars long")
