"""Main text of web pages by composite text density.

The tree of block elements is built leniently from the tags, menus, forms, scripts and the
like are taken out, and each node gets its link-adjusted characters per tag. A node's density
sum adds up the densities of its children; the subtree with the largest sum holds the
article. It is widened along the path to the body while siblings outside of it are at least
as dense as the sparsest node of that path (the threshold) or are headings, and to the
enclosing article; blocks beside the path and outside of the article that are mostly links
stay out, but headings don't.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Names of HTML elements by their role, and of classes that mark what is not the article.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "textarea", "title", "iframe", "template", "xmp", "noframes", "noembed"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
OUT = {
    "aside", "button", "canvas", "dialog", "embed", "footer", "form", "head", "iframe", "input", "menu", "nav", "noscript", "object",
    "option", "script", "select", "style", "svg", "template", "textarea", "title",
}
OUT_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
OUT_WORDS = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "overlay", "pagination", "pager", "popup", "promo", "related", "reply", "replies", "responses", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Words that say nothing by themselves: within an article a name counts only if it has no words but out words and these.
PARTS = {
    "area", "bar", "block", "box", "button", "buttons", "container", "inner", "item", "items", "links", "list", "panel", "posts", "section", "slot",
    "unit", "wrap", "wrapper",
}
#: Out words for what readers wrote, and words that make a class name tell of something beside or within the node.
READERS = {"comment", "comments", "disqus", "reply", "replies", "responses"}
BESIDE = {"has", "no", "with", "without"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul",
}
#: An open element of the key is closed by any of these.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"},
}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?|\"[^\"]*\"|'[^']*'")
_NAME = re.compile(r"[a-z]+")
_HUMP = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "out", "doubtful", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, out: bool = False):
        self.tag, self.parent, self.out, self.doubtful = tag, parent, out, 0
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0


def _doubt(name: str, inside_article: bool) -> int:
    """Of a class name: 0 says nothing, 1 what is usually short beside the article, 2 what readers wrote, which may be longer."""
    found = set(_NAME.findall(_HUMP.sub(r"\1 \2", name).lower()))
    # "with-sidebar" tells what stands beside or within
    if not found.isdisjoint(BESIDE) or OUT_WORDS.isdisjoint(found):
        return 0
    # "social-policy" is a matter of the article, "social-links" is not
    if inside_article and not found <= OUT_WORDS | PARTS:
        return 0
    return 1 if READERS.isdisjoint(found) else 2


def _left_out(tag: str, attributes: str, inside_article: bool) -> tuple[bool, int]:
    """Whether an element is left out, and how far its class or id says that it may have to be."""
    if tag in OUT or (tag == "header" and not inside_article):
        return True, 0
    doubtful, seen = 0, set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
        if not name or name in seen:
            continue
        seen.add(name)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, 0
        if name == "role" and value.lower() in OUT_ROLES:
            return True, 0
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            if tag != "h1":
                doubtful = max(doubtful, 0, *(_doubt(word, inside_article) for word in value.split()))
        elif name == "class" and tag == "article" and {"comment", "comments", "reply"} & set(_NAME.findall(value.lower())):
            return True, 0
    return False, doubtful


def _leave_out_doubtful(root: Node) -> None:
    """Take out the nodes named by a class word, but not one that holds most of the text outside links or the page's title."""
    nodes = _walk(root)
    text, titled, linked, inside = {}, set(), set(), set()
    for node in nodes:
        if node.tag == "a" or (node.parent is not None and id(node.parent) in linked):
            linked.add(id(node))
        if node.tag in ("article", "main") or (node.parent is not None and id(node.parent) in inside):
            inside.add(id(node))
    for node in reversed(nodes):
        own = 0 if id(node) in linked else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, Node) and not c.out]
        text[id(node)] = own + sum(text[id(c)] for c in inner)
        if node.tag in ("h1", "article", "main") or any(id(c) in titled for c in inner):
            titled.add(id(node))
    for node in nodes:
        if node.doubtful:
            most, title = 2 * text[id(node)] > text[id(root)], id(node) in titled
            node.out = not (most and (node.doubtful == 1 or title)) and not (node.doubtful == 1 and title and id(node) in inside)


def parse(page: str) -> Node:
    """The tree of a page: nodes, and texts with their references decoded. Anything parses."""
    root = at = Node("html", None)
    depth_article = 0
    end = 0
    while end < len(page):
        m = _TOKEN.search(page, end)
        if m is None:
            start = page.rfind("<", end)  # a tag that the page breaks off in
            cut = start if start >= 0 and re.match(r"</?[a-zA-Z]|</?\Z|<!", page[start:]) and ">" not in page[start:] else len(page)
            if cut > end:
                at.children.append(html.unescape(page[end:cut]))
            break
        if m.start() > end:
            at.children.append(html.unescape(page[end : m.start()]))
        end = m.end()
        tag = (m[2] or m[6] or "").lower()
        if not tag:
            continue
        if m[1] or m[5]:
            node = at
            while node is not None and node.tag != tag:
                # an inline end tag doesn't reach over a block
                node = None if tag in INLINE and node.tag not in INLINE else node.parent
            if node is not None and node.parent is not None:
                while at is not node:
                    depth_article -= at.tag == "article"
                    at = at.parent
                depth_article -= at.tag == "article"
                at = node.parent
            continue
        attributes = m[3] if m[2] else m[7]
        if tag in ("html", "body") and tag == "html":
            continue
        node = at
        while node.parent is not None:
            closes = (node.tag == "p" and tag in CLOSES_P) or tag in CLOSED_BY.get(node.tag, ())
            if closes:
                at = node.parent
                break
            if node.tag not in INLINE and not (node.tag == "p" or node.tag in CLOSED_BY):
                break
            node = node.parent
        child = Node(tag, at)
        child.out, child.doubtful = _left_out(tag, attributes or "", depth_article > 0)
        at.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, end)
            end = close.end() if close else len(page)
        elif tag not in VOID and not (attributes or "").rstrip().endswith("/"):
            depth_article += tag == "article"
            at = child
    _leave_out_doubtful(root)
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes that are not left out, parents first."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.out]
    return found


def _measure(nodes: list[Node]) -> None:
    """Characters, tags and composite densities of all nodes; inline elements belong to their block."""
    linked = set()
    for node in nodes:
        if node.tag == "a" or (node.parent is not None and id(node.parent) in linked):
            linked.add(id(node))
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        if id(node) in linked:
            node.link_chars += own
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + (node.tag not in INLINE and node.tag not in VOID)
            up.link_tags += node.link_tags + (node.tag == "a")
    body = nodes[0]
    overall = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, lc, t, lt = max(node.chars, 0), max(node.link_chars, 1), max(node.tags, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(1, c - lc) * lc + overall * c + math.e)
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9, base) if lt and base > 1 else c / t
            node.density = max(node.density, 1e-9)
        blocks = [x for x in node.children if isinstance(x, Node) and not x.out and x.tag not in INLINE and x.tag not in VOID]
        # a block without blocks in it stands for itself
        node.sum = sum(x.density for x in blocks) if blocks else node.density


def _mostly_links(node: Node) -> bool:
    return node.link_chars * 2 > node.chars


def _article(nodes: list[Node]) -> Node:
    root = nodes[0]
    best = root
    for node in nodes[1:]:
        if node.tag not in INLINE and node.tag not in VOID and node.sum > best.sum:
            best = node
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    body_path = [n for n in path if n.tag not in INLINE and n is not root] or [best]
    threshold = min(n.density for n in body_path)
    chosen = best
    for inner, outer in zip(path, path[1:]):
        beside = [c for c in outer.children if isinstance(c, Node) and c is not inner and not c.out and c.chars and c.tag not in INLINE]
        if any((c.density >= threshold or c.tag in HEADINGS) and not _mostly_links(c) for c in beside) or any(isinstance(c, str) and c.strip() for c in outer.children):
            chosen = outer
    for tag in ("main", "article"):
        outer = [n for n in path if n.tag == tag]
        if outer and chosen not in path[path.index(outer[-1]) :]:
            chosen = outer[-1]
    # an article keeps its own links
    within = max((i for i, n in enumerate(path) if n.tag in ("article", "main")), default=0)
    for inner, outer in zip(path[within:], path[within + 1 :]):
        for c in outer.children:
            if isinstance(c, Node) and c is not inner and c.tag not in INLINE and c.tag not in HEADINGS and _mostly_links(c):
                c.out = True
    return chosen


def main_text(page: str | None) -> str:
    """The article of a page as one line of text; empty for null, empty and text-free pages."""
    if not page:
        return ""
    nodes = _walk(parse(page))
    _measure(nodes)
    parts: list[str] = []
    stack: list[Node | str] = [_article(nodes)]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
            continue
        if x.tag not in INLINE:
            parts.append(" ")
            stack.append(" ")
        stack += [c for c in reversed(x.children) if isinstance(c, str) or not c.out]
    return " ".join("".join(parts).split())


@F.pandas_udf(StringType())
def _main_texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([main_text(p) for p in batch], dtype="object")


def extract(page: Column) -> Column:
    """The main text of each whole page, a page at a time; see ``main_text``."""
    return _main_texts(page)
