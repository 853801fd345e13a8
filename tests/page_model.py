"""A plain tree builder on the standard library's parser, to check the scanner against."""

from html.parser import HTMLParser

from folioscan.operators.page_parse import NON_TEXT_TAGS, VOID_TAGS


class Node:
    def __init__(self, tag, attrs):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def text(self):
        parts = []
        for child in self.children:
            if isinstance(child, str):
                parts.append("" if self.tag in NON_TEXT_TAGS else child)
            else:
                parts.append(child.text())
        return "".join(parts)

    def text_before(self, tag):
        """Text up to the first element of this tag inside, and whether there is one."""
        parts = []
        for child in self.children:
            if isinstance(child, str):
                parts.append("" if self.tag in NON_TEXT_TAGS else child)
                continue
            text, met = ("", True) if child.tag == tag else child.text_before(tag)
            parts.append(text)
            if met:
                return "".join(parts), True
        return "".join(parts), False

    def fits(self, selector):
        if selector[0] == "#":
            return self.attrs.get("id") == selector[1:]
        if selector[0] == ".":
            return selector[1:] in self.attrs.get("class", "").split()
        return self.tag == selector

    def first(self, selector):
        return next((n for n in self.walk() if n.fits(selector)), None)


class Builder(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.stack = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in VOID_TAGS:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def fields(html, sel):
    """The fields of a page, straight from the tree."""
    root = Builder(html).root

    def src(selector):
        at = root.first(selector)
        image = at and at.first(sel.image)
        return image is not None, image.attrs.get("src") if image is not None else None

    out = {}
    listing = root.first(sel.list_container)
    out["links"] = None
    if listing:
        anchors = [n.first(sel.link) for n in listing.walk() if n.tag == sel.list_item]
        if None not in anchors:
            out["links"] = [a.attrs.get("href") for a in anchors]
    pager = root.first(sel.pager)
    anchor = pager and pager.first(sel.link)
    out["pager_href"] = anchor.attrs.get("href") if anchor is not None else None
    out["has_hero"], out["hero_src"] = src(sel.hero)
    title = root.first(sel.title)
    out["title"] = title.text() if title is not None else None
    out["has_license"], out["license_src"] = src(sel.license)
    block = root.first(sel.license)
    out["license_text"] = block.text() if block is not None else None
    table = root.first(sel.detail)
    out["detail"] = None
    if table is not None:
        out["detail"] = []
        for pos, row in enumerate(n for n in table.walk() if n.tag == sel.row):
            label, cell = row.first(sel.label), row.first(sel.value)
            out["detail"].append(
                {
                    "pos": pos,
                    "title": label.text() if label is not None else None,
                    "value": cell.text() if cell is not None else None,
                    "links": [n.text_before(sel.link)[0] for n in cell.walk() if n.tag == sel.link] if cell is not None else [],
                }
            )
    return out
