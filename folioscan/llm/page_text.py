"""Main text of web pages by composite text density.

A page becomes a small tree. Every node gets its characters per tag, adjusted for links; a node's density
sum adds up those of its children. The subtree of the largest sum holds the article. The smallest density
on the path from the body to that subtree is the threshold for taking in the sections around it.
Elements marked as boilerplate by class, id or role, and forms, are left out before, unless they hold the
article: an ``article`` or ``main``, or most of the text without links.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A comment, a declaration, or a tag. Values are quoted after ``=`` only, and a quote that nothing closes is
# no quote. Quantifiers are possessive and every tag matches, so a broken page costs no more than a good one.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <[!?][^>]*+(?:>|\Z)
      | <(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""")
_TOKEN = re.compile(r"[a-z]+")
# Elements by their role in HTML.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
NEVER = set(
    "head script style noscript template title iframe object embed applet canvas svg math audio video map "
    "nav footer aside button select textarea input datalist menu dialog noembed noframes".split()
)
# Words in class, id or role that mark what is not the article.
MARKS = set(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription paywall "
    "sidebar aside nav navbar navigation navigational menu menus breadcrumb breadcrumbs pagination pager toolbar "
    "footer complementary contentinfo search comment comments commentlist respond reply replies disqus "
    "related recommended recommendations share sharing social login signup widget skip".split()
)
TOP_MARKS = {"header", "masthead", "topbar"}
_KEEP_WHOLE = {"html", "body", "article", "main"}
# Words that make a class name say how the element is laid out, not what it is.
STATES = {"with", "without", "has", "have", "no", "is", "enabled", "disabled"}
# A marked element stays with more than this share of the text around it: one whose names are not all
# marks, as layout wrappers and page-wide forms have them, and one whose names are.
MOST, NEARLY_ALL = 0.5, 0.95
_LAYOUT, _MARKED, _HIDDEN = 1, 2, 3


class _OpenElements:
    """The open elements of a page, with their depths by tag, so that no end tag walks the stack."""

    def __init__(self):
        self.nodes, self.tags = [0], ["#root"]
        self.depths: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: int, tag: str) -> None:
        depth = len(self.nodes)
        self.nodes.append(node)
        self.tags.append(tag)
        self.depths.setdefault(tag, []).append(depth)
        if tag not in INLINE:
            self.blocks.append(depth)

    def innermost(self, tags: set[str]) -> int:
        """Depth of the innermost open element of these tags; 0 if none is open."""
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=0)

    def cut(self, depth: int) -> None:
        """Close the element at this depth and all inside it."""
        while len(self.nodes) > depth:
            self.nodes.pop()
            self.depths[self.tags.pop()].pop()
            if self.blocks[-1] == len(self.nodes):
                self.blocks.pop()


class Page:
    """Nodes of one page in page order: parallel lists, parents before children."""

    def __init__(self, text: str):
        self.tag, self.parent, self.skip = ["#root"], [-1], [False]
        # How an element is marked, and whether one around it (or itself) is left out in any case.
        self.mark, self.never = [0], [False]
        # Whether an element is an ``article`` or ``main`` or inside one.
        self.inside = [False]
        self.pieces: list[tuple[int, str | None]] = []
        self._read(text)
        self._settle()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        mark = _HIDDEN if tag in NEVER else self._mark(self.inside[parent], tag, attributes)
        self.mark.append(mark)
        self.never.append(self.never[parent] or mark == _HIDDEN)
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        return node

    @staticmethod
    def _mark(inside: bool, tag: str, attributes: str) -> int:
        if tag == "header" and not inside:
            return _MARKED
        least = _LAYOUT if tag == "form" else 0
        if not attributes or tag in _KEEP_WHOLE:
            return least
        marked = other = False
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return _HIDDEN
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return _HIDDEN
            if name in ("class", "id", "role"):
                for part in value.split():
                    words = set(_TOKEN.findall(part))
                    if words & MARKS or (not inside and words & TOP_MARKS):
                        marked, other = True, other or bool(words & STATES)
                    else:
                        other = True
        return (_LAYOUT if other or least else _MARKED) if marked else least

    def _settle(self) -> None:
        """Decide which marked elements are left out, by the text without links that they hold.

        Where an ``article`` or ``main`` stands free, marked elements outside it go, and those inside are
        measured against it. Else the largest one frees what it stands in, unless it is an article with
        less text than stands free. Other marked elements are measured against the page.
        """
        n = len(self.tag)
        self.skip = list(self.never)
        if not any(0 < mark < _HIDDEN for mark in self.mark):
            return
        linked, free, inner = [False] * n, [True] * n, [-1] * n
        for i in range(1, n):
            up = self.parent[i]
            linked[i] = linked[up] or self.tag[i] == "a"
            free[i] = free[up] and not self.mark[i]
            inner[i] = i if inner[up] < 0 and self.tag[i] in ("article", "main") else inner[up]
        whole, bare = [0] * n, 0
        for node, piece in self.pieces:
            if piece and not self.never[node] and not linked[node]:
                size = len(" ".join(piece.split()))
                whole[node] += size
                bare += size if free[node] else 0
        # ``part`` leaves out elements with nothing but marks for names.
        part = list(whole)
        for i in range(n - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
            part[self.parent[i]] += 0 if self.mark[i] == _MARKED else part[i]
        holders = [i for i in range(1, n) if inner[i] == i and whole[i]]
        found = any(free[i] and part[i] for i in holders)
        freed = set()
        if holders and not found:
            node = max(holders, key=lambda i: (part[i], self.tag[i] == "main", -i))
            if self.tag[node] == "main" or part[node] > bare:
                found = True
                while node > 0:
                    freed.add(node)
                    node = self.parent[node]
        scope = [0] * n
        for i in range(1, n):
            up = self.parent[i]
            scope[i] = i if inner[i] == i and not self.skip[up] else scope[up]
            if self.skip[up] or self.skip[i] or not self.mark[i]:
                self.skip[i] = self.skip[up] or self.skip[i]
                continue
            around = scope[up]
            if i in freed:
                kept = True
            elif found and inner[i] < 0:
                kept = False
            elif self.mark[i] == _LAYOUT:
                kept = part[i] > MOST * part[around]
            else:
                kept = whole[i] > NEARLY_ALL * whole[around]
            self.skip[i] = not kept
            if kept and self.mark[i] == _MARKED:
                scope[i] = i

    def _read(self, text: str) -> None:
        stack, at = _OpenElements(), 0
        while at < len(text):
            found = _MARKUP.search(text, at)
            if not found:
                break
            if found.start() > at:
                self.pieces.append((stack.nodes[-1], references.unescape(text[at : found.start()])))
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self._close(stack, tag)
                continue
            if tag in CLOSES_PARAGRAPH:
                self._drop(stack, {"p"}, {"div", "section", "article", "td", "th", "li", "blockquote", "button"})
            if tag in SIBLINGS:
                self._drop(stack, SIBLINGS[tag], SCOPES.get(tag, {"select", "datalist"}))
            node = self._open(stack.nodes[-1], tag, found[3])
            if tag not in INLINE:
                self.pieces.append((node, None))
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(text, at)
                at = end.start() if end else len(text)
            stack.push(node, tag)
        if at < len(text):
            self.pieces.append((stack.nodes[-1], references.unescape(text[at:])))

    @staticmethod
    def _drop(stack: _OpenElements, tags: set[str], scope: set[str]) -> None:
        """Close the innermost open element of these tags, unless a scope stands in between."""
        depth = stack.innermost(tags)
        if depth > stack.innermost(scope):
            stack.cut(depth)

    def _close(self, stack: _OpenElements, tag: str) -> None:
        """End tags close up to their element; those of inline elements stop at any block."""
        if tag not in INLINE:
            self.pieces.append((stack.nodes[-1], None))
        depth = stack.innermost({tag})
        if depth and (tag not in INLINE or depth > stack.blocks[-1]):
            stack.cut(depth)


def densities(page: Page) -> tuple[list[float], list[float]]:
    """Composite density of every node, and the sums over children; skipped nodes have none."""
    n = len(page.tag)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    for node, piece in page.pieces:
        if piece and not page.skip[node]:
            size = len(" ".join(piece.split()))
            chars[node] += size
            link_chars[node] += size if linked[node] else 0
    for i in range(n - 1, 0, -1):
        if not page.skip[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    ratio = link_chars[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if page.skip[i] or not chars[i]:
            continue
        c, t = chars[i], max(tags[i], 1)
        lc, lt = max(link_chars[i], 1), max(link_tags[i], 1)
        base = log(c / max(c - link_chars[i], 1) * link_chars[i] + ratio * c + e)
        density[i] = c / t * max(log(max(c * t / (lc * lt), 1.0)) / max(log(base + 1), 0.1), 0.0)
        if i:
            total[page.parent[i]] += density[i]
    return density, total


def article_nodes(page: Page) -> set[int]:
    """Roots of the subtrees that make the article.

    The subtree of the largest density sum (the innermost of equal ones), widened to the innermost
    ``article`` or ``main`` around it; without those, also the sections beside it or its ancestors that
    reach the threshold density, and main headings there. A page too small to have a density is taken whole.
    """
    density, total = densities(page)
    best = max(range(len(total)), key=lambda i: (total[i] or density[i], i))
    if not density[best]:
        return {0}
    path, node = [best], best
    while page.parent[node] >= 0:
        node = page.parent[node]
        path.append(node)
    for node in path:
        if page.tag[node] in ("article", "main"):
            return {node}
    body = next((i for i, node in enumerate(path) if page.tag[node] == "body"), len(path) - 1)
    threshold = min(density[node] for node in path[: body + 1])
    chosen, inside, on_path = {best}, set(path[1 : body + 1]), set(path)
    for node in range(1, len(page.tag)):
        if page.parent[node] in inside and node not in on_path and not page.skip[node]:
            if density[node] >= threshold or page.tag[node] == "h1":
                chosen.add(node)
    return chosen


def page_text(text: str | None) -> str:
    """The article of one page: blocks in page order, joined by one space."""
    page = Page(text or "")
    roots = article_nodes(page)
    within = [False] * len(page.tag)
    for i in range(len(page.tag)):
        within[i] = i in roots or (i > 0 and within[page.parent[i]])
    blocks, block = [], []
    for node, piece in page.pieces:
        if piece is None:
            blocks.append("".join(block))
            block = []
        elif within[node] and not page.skip[node]:
            block.append(piece)
    blocks.append("".join(block))
    return " ".join(" ".join(blocks).split())


def extract_text(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """``(keys.., text, n_chars)``: the main text of every page, and its code points.

    Null or empty HTML, and pages without an article, have an empty text. Broken markup is read as far as
    it goes. Rows are handled one by one, nothing shuffles; repeated rows and other columns do not matter.
    """
    rows = pages.select(*keys, F.col(html))
    schema = T.StructType(
        rows.schema.fields[:-1] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(page.as_py()) for page in batch.column(len(keys))]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), sizes], names=schema.names)

    return rows.mapInArrow(extract, schema)
