"""Main text of web pages by tree scoring.

Each page is parsed into a tree.  A paragraph gives points for its length
and its commas to its parent and, halved, to its grandparent; the points of
a container are discounted by its link density.  If the best container lies
in an article, the article is kept with those of its siblings that carry
text of their own.  Else the best container is kept with all text around it,
at any depth, that is not made of links.  Menus, headers, footers, sidebars,
notices, adverts, forms and comments are not.
Pages are independent: one Arrow pass, no shuffle.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML element names by role.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr"}
DROPPED = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "template", "svg",
                 "canvas", "object", "audio", "video", "dialog", "menu", "fieldset"}
PARAGRAPH = {"p", "pre", "blockquote", "li", "td", "dd", "h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY_ITSELF = {"li", "option", "tr", "td", "th", "dt", "dd"}
ITEMS = {"li", "td", "dd"}
NEVER_BY_NAME = {"html", "body", "article", "main"}
# Words of class, id and role attributes that mark what is not the article.
MARKS = ("ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
         "cookies disclaimer discussion disqus footer gdpr header login masthead menu modal nav navbar navigation "
         "newsletter notice notification overlay pager pagination paywall popup promo promoted promotion recommended "
         "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe tagcloud "
         "toolbar widget widgets alert banner complementary contentinfo search").split()
LAYOUT = {"has", "with", "no", "without", "layout", "page", "main", "wrapper", "container"}

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
# The same without a look at quotes, for pages with a quote that nothing closes.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
TAG_START = re.compile(r"</?[a-zA-Z]")
TEXT = re.compile(r"[^<]+|<")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
MARK_SET = frozenset(MARKS)
# Fixed value: text with at least this share of its characters in links is a menu or a list of links.
LINKED = 0.25


def unwanted(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in NEVER_BY_NAME:
        return False
    if HIDDEN.search(attributes):
        return True
    for m in ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = re.split(r"[^a-z0-9]+", name)
            if not LAYOUT.intersection(parts) and MARK_SET.intersection(parts):
                return True
    return False


class Page:
    """Elements in page order (parent, tag, points) and the blocks of text under them.

    Every step is linear in the page: an element knows its depth, its nearest
    block and whether it lies in a link, and an end that was not found once
    (``>``, ``]]>``, a closing quote) is not looked for again.
    """

    def __init__(self, source: str, by_name: bool = True):
        self.parent, self.tag, self.out = [-1], ["#root"], [False]
        self.blocks: list[tuple[int, str, int]] = []     # element, text, characters in links
        self._block, self._linked, self._depth = [0], [False], [0]
        self._text: list[str] = []
        self._links = 0
        self._at = 0
        self._open = [0]
        self._depths: dict[str, list[int]] = {}          # where elements of a name stand open
        self._parse(source, by_name)

    def _flush(self) -> None:
        if self._text:
            words = " ".join(html.unescape("".join(self._text)).split())
            if words:
                self.blocks.append((self._at, words, min(self._links, len(words))))
            self._text, self._links = [], 0

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            self._depths[self.tag[self._open.pop()]].pop()

    def _parse(self, source: str, by_name: bool) -> None:
        at, end, tag_of, cdata, closes = 0, len(source), TAG, True, True
        while at < end:
            begin = at
            if source[at] == "<" and closes:
                if source.startswith("<!--", at):
                    at = COMMENT.match(source, at).end()
                    continue
                if cdata and source.startswith("<![CDATA[", at):
                    close = source.find("]]>", at)
                    cdata = close >= 0
                    if cdata:
                        at = close + 3
                        continue
                if source[at + 1:at + 2] in ("!", "?") and at + 1 < end:
                    close = source.find(">", at)
                    closes = close >= 0
                    if closes:
                        at = close + 1
                        continue
                elif source[at + 1:at + 2] == "/" or source[at + 1:at + 2].isalpha():
                    m = tag_of.match(source, at)
                    if m is None and tag_of is TAG and TAG_START.match(source, at):
                        tag_of = PLAIN_TAG       # the page ended inside the tag or inside its quotes
                        m = tag_of.match(source, at)
                    if m is None and TAG_START.match(source, at):
                        closes = False
                    if m is not None:
                        at = m.end()
                        tag = m[2].lower()
                        if m[1]:
                            self._end(tag)
                            continue
                        self._begin(tag, m[3], by_name)
                        if tag in RAW:   # its content is not markup: go to its end tag, or to the end of the page
                            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                            at = close.start() if close else end
                        continue
            at = TEXT.match(source, begin).end() if closes else end     # without a ">" ahead the rest is text
            self._add(source[begin:at])

    def _add(self, text: str) -> None:
        top = self._open[-1]
        if self.out[top]:
            return
        if not self._text:
            self._at = self._block[top]
        self._text.append(text)
        if self._linked[top]:
            self._links += len(text.strip())

    def _begin(self, tag: str, attributes: str, by_name: bool) -> None:
        if tag not in INLINE:
            self._flush()
            block = self._block[self._open[-1]]
            kind = self.tag[block]
            if block and (kind == "p" or kind == tag and tag in CLOSED_BY_ITSELF):
                self._close_to(self._depth[block])
        if tag in VOID:
            return
        top, new = self._open[-1], len(self.tag)
        self.parent.append(top)
        self.tag.append(tag)
        self.out.append(self.out[top] or tag in DROPPED or by_name and unwanted(tag, attributes))
        self._block.append(self._block[top] if tag in INLINE else new)
        self._linked.append(self._linked[top] or tag == "a")
        self._depth.append(len(self._open))
        if not attributes.rstrip().endswith("/") or tag not in ("svg", "path"):
            self._depths.setdefault(tag, []).append(len(self._open))
            self._open.append(new)

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        at = self._depths.get(tag)
        # An inline element is not closed across the block that it lies around.
        if at and (tag not in INLINE or at[-1] > self._depth[self._block[self._open[-1]]]):
            self._close_to(at[-1])

    def finish(self) -> None:
        self._flush()


def best_text(page: Page) -> str:
    page.finish()
    if not page.blocks:
        return ""
    n = len(page.tag)
    points, worths, chars, links = [0.0] * n, [0.0] * n, [0] * n, [0] * n
    for at, text, linked in page.blocks:
        worth = 1 + text.count(",") + min(len(text) / 100, 3)
        holder = page.parent[at] if page.tag[at] in PARAGRAPH else at
        holder = max(holder, 0)
        points[holder] += worth
        if page.parent[holder] >= 0:
            points[page.parent[holder]] += worth / 2
        worths[at] += worth
        chars[at] += len(text)
        links[at] += linked
    for i in range(n - 1, 0, -1):   # children come last
        up = page.parent[i]
        worths[up] += worths[i]
        chars[up] += chars[i]
        links[up] += links[i]
    score, value = ([p * (1 - links[i] / chars[i]) if chars[i] else 0.0 for i, p in enumerate(x)] for x in (points, worths))
    best = max(range(n), key=lambda i: (score[i], -i))
    up = best
    while up >= 0 and page.tag[up] != "article":
        up = page.parent[up]
    if up >= 0:
        best = up
        kept, own = article_and_siblings(page, best, value, chars, links), set()
    else:
        kept, own = best_and_around(page, best, value, chars, links)
    inside = [i in kept for i in range(n)]
    for i in range(1, n):   # parents come first
        inside[i] = inside[i] or inside[page.parent[i]]
    return " ".join(text for at, text, linked in page.blocks
                    if inside[at] or at in own and (at == page.parent[best] or linked < LINKED * len(text)))


def article_and_siblings(page: Page, best: int, value: list[float], chars: list[int], links: list[int]) -> set[int]:
    """The article and those of its siblings that carry text of their own."""
    kept = {best}
    for i in range(len(page.tag)):
        if i != best and page.parent[i] == page.parent[best] and chars[i]:
            density = links[i] / chars[i]
            if value[i] and value[i] >= 0.2 * value[best] or page.tag[i] == "p" and density < LINKED or page.tag[i] in ("h1", "h2", "h3") and not density:
                kept.add(i)
    return kept


def best_and_around(page: Page, best: int, value: list[float], chars: list[int], links: list[int]) -> tuple[set[int], set[int]]:
    """The best container with all that is not made of links on the way up to the root, and that way.

    Elements of many links are looked into; a list item or cell of such an
    element counts only when it is worth a paragraph of the best container.
    """
    path, up = set(), page.parent[best]
    while up >= 0:
        path.add(up)
        up = page.parent[up]
    kept, entered = {best}, set(path)
    below = [0] * len(page.tag)
    for at, _, _ in page.blocks:
        below[at] += 1
    for i in range(len(page.tag) - 1, 0, -1):   # children come last
        below[page.parent[i]] += below[i]
    paragraph = value[best] / max(below[best], 1)
    for i in range(1, len(page.tag)):   # parents come first
        if i == best or i in path or page.parent[i] not in entered or not chars[i]:
            continue
        if links[i] >= LINKED * chars[i]:
            entered.add(i)
        elif page.parent[i] in path or page.tag[i] not in ITEMS or value[i] >= paragraph:
            kept.add(i)
    return kept, path


def main_text(source: str | None) -> str:
    """The article of one page; empty for null, for empty pages and for pages without text."""
    if not source:
        return ""
    return best_text(Page(source)) or best_text(Page(source, by_name=False))


def extracted(sources: pa.Array) -> pa.Array:
    return pa.array([main_text(x.as_py()) for x in sources], pa.string())


def page_text(source: Column) -> Column:
    """The main text of a page; never null."""
    return F.arrow_udf(extracted, T.StringType())(source)


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars`` (code points).

    Every row of the input has its row, repeated and null ids included;
    extra columns are ignored; an empty table gives an empty result.
    """
    return (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), page_text(F.col(source)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
