"""Main text of a web page by composite text density.

Each node of the page's tree gets a density: characters for each tag below it,
lowered where much of the text is links.  A node's density sum adds up its
children's densities; the node with the largest sum holds the main text.  Its
enclosing ``article`` or ``main`` is taken where there is one; where there is
none, the lowest density on the path from the body to it is a threshold.  Siblings
that reach it join in, and so does the part with the largest density sum of every
element that reaches it, as do all elements around it.  Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are known by tag, role, class or id and count for nothing.

Null and empty pages give an empty text, very long and deep ones take time in proportion.  Further
columns are not read.  Tags that are open at the end are
closed; a tag that never ends is text's end.  Rows are worked on one by one, so
equal or null ids do no harm.  No shuffle; memory is that of one batch of pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"""<!--(?:.*?--!?>|.*+)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$)|<[!?/][^>]*+(?:>|$)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# HTML's elements by how their content is read.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "caption", "tbody", "tfoot", "thead", "tr", "ul",
}
#: An element of the first kind ends an open one of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ASIDE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "svg", "object", "canvas", "label", "input"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
ASIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promoted", "banner", "cookie", "cookies", "consent", "gdpr",
    "notice", "alert", "menu", "nav", "navbar", "navigation", "sidebar", "footer", "masthead", "comment", "comments", "disqus", "replies", "respond", "share",
    "sharing", "social", "related", "breadcrumb", "breadcrumbs", "newsletter", "subscribe", "popup", "modal", "login", "signup", "pagination", "pager", "widget",
}
PAGE_HEADER = {"header"}
KEPT = {"html", "body", "article", "main"}
SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


def _aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in KEPT:
        return False
    if tag in ASIDE_TAGS or (tag in PAGE_HEADER and not in_article):
        return True
    if not attributes or attributes.isspace():
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True
        if name == "role" and value.lower() in ASIDE_ROLES:
            return True
        if name in ("class", "id"):
            words = {w.lower() for w in SPLIT.split(value)}
            if words & ASIDE_NAMES or (not in_article and words & PAGE_HEADER):
                return True
    return False


class Page:
    """The tree as parallel lists; a node's parent has a smaller number."""

    def __init__(self, source: str):
        self.tag, self.parent, self.skip = ["body"], [-1], [False]
        self.chars, self.tags, self.link_chars, self.link_tags = [0], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # block, node, text
        self.in_article = [False]
        # Places on the stack, innermost last: by tag, of containers, of blocks.
        self.where: dict[str, list[int]] = defaultdict(list)
        self.stops: list[int] = []
        self.blocks: list[int] = []
        self.block, self.stack = 0, [0]
        self._parse(source)

    def _open(self, tag: str, attributes: str) -> None:
        stack = self.stack
        if tag in BLOCK:
            self._close_implied({"p"})
        if tag in ENDS:
            self._close_implied(ENDS[tag])
        up = stack[-1]
        node = len(self.tag)
        in_article = self.in_article[up]
        self.in_article.append(in_article or tag in ("article", "main"))
        self.tag.append(tag)
        self.parent.append(up)
        self.skip.append(self.skip[up] or _aside(tag, attributes, in_article))
        for counts in (self.chars, self.tags, self.link_chars, self.link_tags):
            counts.append(0)
        if tag not in VOID:
            self.where[tag].append(len(stack))
            if tag in BLOCK:
                self.blocks.append(len(stack))
            if tag in BLOCK or tag in ("td", "th"):
                self.stops.append(len(stack))
            stack.append(node)

    def _close_implied(self, tags: set[str]) -> None:
        """Close the innermost open element of ``tags`` unless a container stands above it."""
        at = max((self.where[tag][-1] for tag in tags if self.where[tag]), default=0)
        if at and at >= (self.stops[-1] if self.stops else 0):
            self._cut(at)

    def _cut(self, at: int) -> None:
        for node in self.stack[at:]:
            self.where[self.tag[node]].pop()
        for places in (self.stops, self.blocks):
            while places and places[-1] >= at:
                places.pop()
        del self.stack[at:]

    def _close(self, tag: str) -> None:
        at = self.where[tag][-1] if self.where[tag] else 0
        # An inline end tag doesn't close blocks.
        if at and (tag in BLOCK or at > (self.blocks[-1] if self.blocks else 0)):
            self._cut(at)

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        node = self.stack[-1]
        self.pieces.append((self.block, node, text))
        self.chars[node] += len("".join(text.split()))

    def _parse(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            slash, name, attributes = m[1] or m[4], m[2] or m[5], m[3] or m[6] or ""
            if not name:
                continue
            tag = name.lower()
            if tag in BLOCK or tag in ("td", "th"):
                self.block += tag in BLOCK
                if tag not in BLOCK:
                    self.pieces.append((self.block, self.stack[-1], " "))
            if slash:
                if tag not in ("html", "body"):
                    self._close(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = close.end() if close else end
            elif tag in ("html", "body"):
                pass
            elif tag == "br":
                self.pieces.append((self.block, self.stack[-1], " "))
            else:
                self._open(tag, attributes)

    def _density(self) -> list[float]:
        n = len(self.tag)
        all_chars, all_links = 0, 0
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.tag[i] == "a"
        for i in range(n):
            all_chars += self.chars[i]
            all_links += self.chars[i] * linked[i]
            if self.skip[i]:
                self.chars[i] = 0
            self.link_chars[i] = self.chars[i] * linked[i]
        for i in range(n - 1, 0, -1):
            if self.skip[i]:
                continue
            up = self.parent[i]
            self.chars[up] += self.chars[i]
            self.link_chars[up] += self.link_chars[i]
            self.tags[up] += self.tags[i] + 1
            self.link_tags[up] += self.link_tags[i] + (self.tag[i] == "a")
        linkage = all_links / (all_chars or 1)
        out = []
        for c, t, lc, lt in zip(self.chars, self.tags, self.link_chars, self.link_tags, strict=True):
            if not c:
                out.append(0.0)
                continue
            base = math.log(c / max(c - lc, 1) * lc + linkage * c + math.e)
            ratio = c / max(lc, 1) * max(t, 1) / max(lt, 1)
            # On a page with few links the base is near 1; its logarithm is held at 1 then.
            out.append(c / max(t, 1) * math.log(max(ratio, 1)) / max(math.log(base), 1.0))
        return out

    def main(self) -> str:
        density = self._density()
        n = len(self.tag)
        sums = [0.0] * n
        for i in range(1, n):
            if not self.skip[i] and (self.tag[i] in BLOCK or self.tag[i] in ("td", "th")):
                sums[self.parent[i]] += density[i]
        best = max(range(n), key=lambda i: (sums[i], -i))
        path, node = [], best
        while node >= 0:
            path.append(node)
            node = self.parent[node]
        chosen = next((i for i in reversed(path) if self.tag[i] in ("article", "main")), None)
        roots = {chosen}
        if chosen is None:
            least = min(density[i] for i in path)
            roots = {best} | {i for i in range(1, n) if best and self.parent[i] == self.parent[best] and self.tag[i] in BLOCK and density[i] >= least}
            densest = list(range(n))  # of each node's subtree
            for i in range(n - 1, 0, -1):
                up = self.parent[i]
                if not self.skip[i] and (sums[densest[i]], -densest[i]) > (sums[densest[up]], -densest[up]):
                    densest[up] = densest[i]
            reached = [True] * n
            for i in range(1, n):
                block = self.tag[i] in BLOCK or self.tag[i] in ("td", "th")
                reached[i] = reached[self.parent[i]] and block and not self.skip[i] and density[i] >= least
                if reached[i]:
                    roots.add(densest[i])
        inside = [False] * n
        for i in range(n):
            inside[i] = (i in roots or (i > 0 and inside[self.parent[i]])) and not self.skip[i]
        blocks: dict[int, list[str]] = {}
        for block, node, text in self.pieces:
            if inside[node]:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(b for b in joined if b)


def main_text(source: object) -> str:
    return Page(source).main() if isinstance(source, str) and source else ""


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        text = [main_text(x) for x in batch["html"]]
        yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> page_id, url, text, n_chars."""
    wanted = pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html")
    return wanted.mapInPandas(_pages, "page_id long, url string, text string, n_chars long")
