"""One pass over raw HTML that yields every field of a page.

Spark's ``xpath`` functions need well-formed XML, and crawled pages are not, so this is the one
place where rows go through Python: ``mapInArrow`` hands whole Arrow batches to a small tolerant
scanner. Only the key columns and the HTML travel to Python and only the small fields come back. A
page is left as soon as every wanted element has been closed, so links at the top of a long page
cost little; attributes and entities are decoded only where a field needs them.

Everything after the parse (cleaning, label mapping, widening, routing) is native expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Elements that are read as having no content, obsolete ones among them.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "basefont bgsound command frame image isindex keygen menuitem nextid spacer".split()
)
# Elements whose content holds no tags, and those whose content is not page text.
RAW_TAGS = frozenset(["script", "style"])
NON_TEXT_TAGS = frozenset(["script", "style", "template"])

# One piece of markup: a tag, a comment (which may run to the end), marked text, or a declaration.
# Quantifiers are possessive, so a broken page costs no more than a good one.
_MARKUP = re.compile(
    r"""<(?:
        (/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>
      | !--(?:>|->|.*?(?:--!?>|\Z))
      | !\[CDATA\[(.*?)\]\]>
      | [!?/][^>]*+>
    )""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s/=>][^\s/=>]*)(?:\s*=+\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_NAMED = re.compile(r"(?:id|class)\s*=", re.I)
_BARE_VALUE_END = re.compile(r"""=\s*[^\s"'>][^\s>]*/$""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW_TAGS}


@dataclass(frozen=True)
class Selectors:
    """Where the fields of a page sit: ``#id``, ``.class`` or a plain tag name."""

    # The element ids and classes of the catalogue's own pages.
    list_container: str = "#wrtList"
    pager: str = ".end"
    hero: str = ".imgD"
    title: str = ".tit_txt3"
    license: str = ".copyD"
    detail: str = ".tb_bbs"
    # Tags looked up below those elements.
    list_item: str = "li"
    link: str = "a"
    image: str = "img"
    row: str = "tr"
    label: str = "th"
    value: str = "td"


_string, _bool = T.StringType(), T.BooleanType()
_links = T.ArrayType(_string)
DETAIL_ROW = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("title", _string),  # null: the row has no label cell
        T.StructField("value", _string),  # null: the row has no value cell
        T.StructField("links", _links),
    ]
)
# Parts a caller can ask for -> the columns each one yields.
PARTS = {
    "links": [("links", _links)],  # null: the page has no usable list
    "pager": [("pager_href", _string)],
    "hero": [("has_hero", _bool), ("hero_src", _string)],
    "title": [("title", _string)],
    "license": [("has_license", _bool), ("license_src", _string), ("license_text", _string)],
    "detail": [("detail", T.ArrayType(DETAIL_ROW))],  # null: the page has no detail table
}
ITEM_PARTS = ("hero", "title", "license", "detail")


def _attributes(raw: str) -> dict[str, str]:
    """Decoded attributes of a tag; of a repeated name the last value counts."""
    found = {}
    for name, value in _ATTRIBUTE.findall(raw):
        if value[:1] in ("'", '"') and len(value) > 1 and value[0] == value[-1]:
            value = value[1:-1]
        found[name.lower()] = unescape(value)
    return found


class _Outline:
    """The wanted elements of a page and all elements below them, in document order.

    ``found`` maps a selector to the first element it fits. Descendants of element ``i`` are the
    elements ``i + 1 .. end[i] - 1``. An end tag closes everything opened since its start tag and is
    ignored when there is none; nothing else is implied.
    """

    def __init__(self, html: str, wanted: Iterable[str]):
        self.tags: list[str] = []
        self.attrs: list[str] = []
        self.end: list[int] = []
        self.text: list[str] = []
        self.text_from: list[int] = []
        self.text_to: list[int] = []
        self.found: dict[str, int] = {}
        self._by_tag: dict[str, list[int]] | None = None
        self._missing = set(wanted)
        self._unclosed: set[int] = set()  # wanted elements that are open
        self._scan(html)

    def _scan(self, html: str) -> None:
        open_tags: list[tuple[str, int]] = []
        open_count: dict[str, int] = {}
        missing, unclosed = self._missing, self._unclosed
        # The loop runs once per piece of markup and is what a page costs, so its small steps are written out.
        tags, attrs, ends, texts, text_from, text_to = self.tags, self.attrs, self.end, self.text, self.text_from, self.text_to
        search, limit, pos = _MARKUP.search, html.rfind(">") + 1, 0
        while missing or unclosed:
            markup = search(html, pos, limit)
            if markup is None:
                self._add_text(html[pos:], open_tags)
                break
            start, end = markup.span()
            if unclosed and start > pos and not (open_tags and open_tags[-1][0] in NON_TEXT_TAGS):
                text = html[pos:start]
                texts.append(unescape(text) if "&" in text else text)
            pos = end
            slash, name, raw, marked = markup.groups()
            if name is None:
                if marked:
                    self._add_text(marked, open_tags, decode=False)
                elif html.startswith("<!--", start) and not html.endswith("-->", 0, end):
                    pos = self._comment_end(html, start, end)
                continue
            name = name.lower()
            if slash:
                if open_count.get(name):
                    last = None
                    while last != name:
                        last, index = open_tags.pop()
                        open_count[last] -= 1
                        if index >= 0:
                            ends[index], text_to[index] = len(tags), len(texts)
                            unclosed.discard(index)
                continue
            fits = self._first_fits(name, raw) if missing and (raw or name in missing) else ()
            index = -1
            if fits or unclosed:
                index, at = len(tags), len(texts)
                tags.append(name)
                attrs.append(raw)
                ends.append(index + 1)
                text_from.append(at)
                text_to.append(at)
                if fits:
                    missing.difference_update(fits)
                    self.found.update(dict.fromkeys(fits, index))
                    unclosed.add(index)
            if name in VOID_TAGS or (raw and raw[-1] == "/" and not _BARE_VALUE_END.search(raw)):
                self._close(index)
                continue
            open_tags.append((name, index))
            open_count[name] = open_count.get(name, 0) + 1
            if name in RAW_TAGS:
                stop = _RAW_END[name].search(html, pos)
                pos = stop.start() if stop else len(html)
        for _, index in reversed(open_tags):
            self._close(index)

    @staticmethod
    def _comment_end(html: str, start: int, pos: int) -> int:
        """An unclosed comment runs to the end of the page, also past its last tag."""
        return pos if html[start:pos].endswith(("--!>", "<!-->", "<!--->")) else len(html)

    def _add_text(self, text: str, open_tags: list[tuple[str, int]], decode: bool = True) -> None:
        if self._unclosed and text and not (open_tags and open_tags[-1][0] in NON_TEXT_TAGS):
            self.text.append(unescape(text) if decode and "&" in text else text)

    def _first_fits(self, name: str, raw: str) -> list[str]:
        names = [name]
        if raw and _NAMED.search(raw):
            attributes = _attributes(raw)
            if "id" in attributes:
                names.append("#" + attributes["id"])
            names.extend(["." + token for token in attributes.get("class", "").split()])
        return [n for n in names if n in self._missing]

    def _close(self, index: int) -> None:
        if index >= 0:
            self.end[index] = len(self.tags)
            self.text_to[index] = len(self.text)
            self._unclosed.discard(index)

    def first(self, below: int | None, tag: str) -> int | None:
        if below is None:
            return None
        places = self._places().get(tag, ())
        at = bisect_right(places, below)
        return places[at] if at < len(places) and places[at] < self.end[below] else None

    def every(self, below: int, tag: str) -> list[int]:
        places = self._places().get(tag, [])
        return places[bisect_right(places, below) : bisect_left(places, self.end[below])]

    def _places(self) -> dict[str, list[int]]:
        """Elements by tag, in document order; listed once, after the scan."""
        if self._by_tag is None:
            self._by_tag = {}
            for index, tag in enumerate(self.tags):
                self._by_tag.setdefault(tag, []).append(index)
        return self._by_tag

    def text_of(self, index: int | None) -> str | None:
        if index is None:
            return None
        return "".join(self.text[self.text_from[index] : self.text_to[index]])

    def link_texts(self, below: int, tag: str) -> list[str]:
        """Texts of all links below an element. A link ends where the next one starts, also an unclosed one.

        So every piece of text is in one link at most, and links take no more room than their element.
        """
        places = self.every(below, tag)
        ends = [min(self.text_to[a], self.text_from[b]) for a, b in zip(places, places[1:])]
        ends += [self.text_to[a] for a in places[-1:]]
        return ["".join(self.text[self.text_from[a] : end]) for a, end in zip(places, ends)]

    def text_within(self, index: int, length: int) -> str:
        """The beginning of an element's text, up to ``length`` characters that are not blanks."""
        pieces = []
        for at in range(self.text_from[index], self.text_to[index]):
            for char in self.text[at]:
                pieces.append(char)
                length -= char != " "
                if not length:
                    return "".join(pieces)
        return "".join(pieces)

    def attribute(self, index: int | None, name: str) -> str | None:
        return None if index is None else _attributes(self.attrs[index]).get(name)


def _links_of(page: _Outline, sel: Selectors) -> list | None:
    """Link of the first ``a`` of every item; one item without an ``a`` spoils the whole page."""
    container = page.found.get(sel.list_container)
    if container is None:
        return None
    anchors = [page.first(item, sel.link) for item in page.every(container, sel.list_item)]
    return None if None in anchors else [page.attribute(a, "href") for a in anchors]


def _known_rows(page: _Outline, sel: Selectors, rows: list[int], labels: dict[str, str]) -> list[tuple]:
    """Rows as the item pass needs them: cell text for the first row of each known label only.

    Unclosed rows nest, so the text of every row would grow with the square of the page. A label that
    runs on into the next row is read until it is longer than any known one.
    """
    longest, seen, out = max(map(len, labels)), set(), []
    for pos, row in enumerate(rows):
        label, cell = page.first(row, sel.label), page.first(row, sel.value)
        title = None
        if label is not None:
            runs_on = pos + 1 < len(rows) and page.text_to[label] > page.text_from[rows[pos + 1]]
            title = page.text_within(label, longest + 1) if runs_on else page.text_of(label)
        name = None if title is None else labels.get(title.replace(" ", ""))
        value, links = None if cell is None else "", []
        if name is not None and name not in seen and cell is not None:
            seen.add(name)
            value, links = page.text_of(cell), page.link_texts(cell, sel.link)
        out.append((pos, title, value, links))
    return out


def _detail_of(page: _Outline, sel: Selectors, labels: dict[str, str] | None = None) -> list | None:
    table = page.found.get(sel.detail)
    if table is None:
        return None
    rows, found = [], page.every(table, sel.row)
    if labels is not None:
        return [dict(zip(DETAIL_ROW.names, row)) for row in _known_rows(page, sel, found, labels)]
    for pos, row in enumerate(found):
        cell = page.first(row, sel.value)
        links = [] if cell is None else page.link_texts(cell, sel.link)
        rows.append((pos, page.text_of(page.first(row, sel.label)), page.text_of(cell), links))
    return [dict(zip(DETAIL_ROW.names, row)) for row in rows]


def _fields(html: str | None, sel: Selectors, parts: tuple[str, ...], labels: dict[str, str] | None = None) -> dict:
    where = {
        "links": sel.list_container, "pager": sel.pager, "hero": sel.hero,
        "title": sel.title, "license": sel.license, "detail": sel.detail,
    }
    page = _Outline(html or "", [where[part] for part in parts])
    out: dict = {}
    for part in parts:
        at = page.found.get(where[part])
        image = page.first(at, sel.image)
        if part == "links":
            out["links"] = _links_of(page, sel)
        elif part == "pager":
            out["pager_href"] = page.attribute(page.first(at, sel.link), "href")
        elif part == "hero":
            out["has_hero"], out["hero_src"] = image is not None, page.attribute(image, "src")
        elif part == "title":
            out["title"] = page.text_of(at)
        elif part == "license":
            out["has_license"], out["license_src"] = image is not None, page.attribute(image, "src")
            out["license_text"] = page.text_of(at)
        elif part == "detail":
            out["detail"] = _detail_of(page, sel, labels)
    return out


def parse_pages(
    pages: DataFrame,
    parts: Iterable[str] = ITEM_PARTS,
    keys: Iterable[str] = ("page_id", "url"),
    html: str = "html",
    selectors: Selectors = Selectors(),
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """Key columns plus the columns of the asked ``parts`` (see ``PARTS``), one row per page.

    With ``labels`` (known label -> item column) detail rows carry cell text only where an item takes
    it: in the first row of each column. Narrow: the partitioning of ``pages`` is kept and nothing is shuffled. Null HTML reads as an
    empty page.
    """
    parts, keys = tuple(parts), list(keys)
    narrow = pages.select(*keys, html)
    fields = [T.StructField(name, kind) for part in parts for name, kind in PARTS[part]]
    schema = T.StructType(narrow.schema.fields[: len(keys)] + fields)
    arrow_schema = to_arrow_schema(schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_fields(text, selectors, parts, labels) for text in batch.column(len(keys)).to_pylist()]
            columns = [batch.column(i).cast(arrow_schema.field(i).type) for i in range(len(keys))]
            for field in list(arrow_schema)[len(keys) :]:
                columns.append(pa.array([row[field.name] for row in rows], type=field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return narrow.mapInArrow(parse, schema)
