import random
import time

import page_model
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioscan.operators.links import extract_links, last_page, link_errors
from folioscan.operators.page_parse import PARTS, Selectors, _fields, parse_pages

SEL = Selectors()
ALL = tuple(PARTS)

PIECES = [
    '<ul id="wrtList">', "<ul id=wrtList class='a b'>", "</ul>", "<li>", "</li>", "<LI class=x>",
    '<a href="/v?a=1&amp;b=2">', "<a href='/x>y'>", "<a href=/bare/>", "<a>", "<a href>", "</a>", "</A >",
    '<div class="imgD">', '<div class="x imgD y">', "<img src='/i.png'/>", "<img>", "<img src=/a.png alt='>'>",
    '<h3 class="tit_txt3">', "</h3>", '<div class=copyD>', "</div>", '<table class="tb_bbs">', "</table>",
    "<tr>", "</tr>", "<th>", "</th>", "<td>", "</td>", "<br>", "<br/>", "<p>", "</p>", "</b>", "<b>",
    '<span class="end">', "</span>", "<!-- <li><a href=no> -->", "<!doctype html>", "<?php x ?>",
    "<script>var t='</p><li>';</script>", "<style>p{}</style>", "<script src='/s.js'></script>",
    "text", " &amp; &copy; &middot; ", "a < b", "한글", "\n\t", "&#65;", "<tr><th>UCI</th><td>1<a>n</a></td></tr>",
    "<template>hidden</template>", "<svg/>", "<li/>", '<a href="1" href="2">', "<td a=b/>",
]


def test_random_markup_equals_tree_model():
    rng = random.Random(7)
    for _ in range(4000):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 40)))
        assert _fields(html, SEL, ALL) == page_model.fields(html, SEL), html


def test_each_part_alone_equals_all_parts():
    """Leaving a page early must not change a field."""
    rng = random.Random(8)
    for _ in range(1500):
        html = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 40)))
        whole = _fields(html, SEL, ALL)
        for part in ALL:
            assert _fields(html, SEL, (part,)) == {name: whole[name] for name, _ in PARTS[part]}, html


def test_archive_equals_tree_model(spark):
    sel = Selectors(list_container="nav", title="h1", license="footer", detail="article", pager=".ad")
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("html").collect()
    for (html,) in pages:
        assert _fields(html, sel, ALL) == page_model.fields(html, sel)


@pytest.mark.parametrize("piece", ["<a ", "<!--", "</", "<a b=\"", "<", "<![CDATA[", "<script>", "<p><b>", "</x>", "='\"<a "])
def test_broken_markup_takes_linear_time(piece):
    start = time.time()
    _fields(piece * 60_000, SEL, ALL)
    _fields(piece * 60_000 + ">", SEL, ALL)
    assert time.time() - start < 10


@pytest.mark.parametrize(
    ("html", "links"),
    [
        ('<ul id="wrtList"><li><a href="/1"></a><a href="/2"></a></li><li><a href="/1"></a></li></ul>', ["/1", "/1"]),
        ('<ul id="wrtList"><li><a href="/1"></a></li><li>bare</li></ul>', None),
        ('<ul id="wrtList"><li><ul><li><a href="/1">x</a></li></ul></li></ul>', ["/1", "/1"]),
        ('<ul id="wrtList"><li><a>x</a></li></ul>', [None]),
        ('<ul id="wrtList"></ul><li><a href="/out"></a></li>', []),
        ("<ul><li><a href='/1'></a></li></ul>", None),
        ("", None),
    ],
)
def test_links(html, links):
    assert _fields(html, SEL, ("links",)) == {"links": links}


def test_link_rows_and_errors(spark):
    pages = spark.createDataFrame(
        [
            (1, "u1", '<ul id="wrtList"><li><a href="/b"></a></li><li><a href="/a"></a></li></ul>'),
            (2, "u2", "<p>"),
            (3, "u3", None),
            (4, "u4", '<ul id="wrtList"><li><a>x</a></li></ul>'),
        ],
        "page_id long, url string, html string",
    )
    parsed = parse_pages(pages, ["links"])
    rows = [tuple(r) for r in extract_links(parsed, "http://h").orderBy("page_id", "pos").collect()]
    assert rows == [(1, 0, "/b", "http://h/b"), (1, 1, "/a", "http://h/a"), (4, 0, None, None)]
    assert [tuple(r) for r in link_errors(parsed).orderBy("page_id").collect()] == [
        (2, "PAGE_URL_ERROR : no usable link list/u2"),
        (3, "PAGE_URL_ERROR : no usable link list/u3"),
        (4, "PAGE_URL_ERROR : link without address/u4"),
    ]


def test_last_page(spark):
    html = ['<a class="end" href="?p=9"></a>', '<b class="x end"><i><a href="?p=12">', "<p>", None]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit(""))
    got = [r[1] for r in last_page(parse_pages(pages, ["pager"])).orderBy("page_id").collect()]
    assert got == [None, 12, None, None]


def test_unclosed_rows_take_linear_space():
    """Rows that nest would each hold the rest of the page; the item pass reads the first of each label only."""
    from folioscan.functions.attributes import ATTRIBUTES

    for row in ("<tr><th>UCI</th><td>x", "<tr><th>UCI<td>x", "<tr><th>zzz</th><td>y", "<tr><th>zzz", "<tr><td>y"):
        page = '<table class="tb_bbs">' + row * 20_000
        rows = _fields(page, SEL, ("detail",), ATTRIBUTES)["detail"]
        assert len(rows) == 20_000
        assert sum(len(r["title"] or "") + len(r["value"] or "") for r in rows) < 10 * len(page)


def test_unclosed_links_take_linear_space():
    """A link ends where the next one starts, so the names of unclosed author links are not repeated."""
    from folioscan.functions.attributes import ATTRIBUTES

    for labels in (None, ATTRIBUTES):
        sizes = []
        for n in (4_000, 8_000, 16_000):
            page = '<table class="tb_bbs"><tr><th>저작자</th><td>' + "<a href=/x>some name " * n
            (row,) = _fields(page, SEL, ("detail",), labels)["detail"]
            assert row["links"] == ["some name "] * n
            sizes.append(len(row["value"]) + sum(map(len, row["links"])))
        assert sizes == [sizes[0], 2 * sizes[0], 4 * sizes[0]]


def test_labels_change_no_item():
    """With labels given, what the item takes is the same."""
    from folioscan.functions.attributes import ATTRIBUTES

    rng = random.Random(9)
    cells = ["<tr>", "<th>", "<td>", "</th>", "</td>", "</tr>", "UCI", "U CI", "ICN", "zzz", " ", "저작자", "<a>n</a>", "\t"]
    for _ in range(3000):
        html = '<table class="tb_bbs">' + "".join(rng.choice(cells) for _ in range(rng.randint(1, 40)))
        full, known = (_fields(html, SEL, ("detail",), labels)["detail"] for labels in (None, ATTRIBUTES))
        seen = set()
        assert len(full) == len(known)
        for a, b in zip(full, known):
            name = ATTRIBUTES.get((a["title"] or "").replace(" ", ""))
            assert (a["title"] is None, a["value"] is None) == (b["title"] is None, b["value"] is None), html
            assert name == ATTRIBUTES.get((b["title"] or "").replace(" ", "")), html
            if name and name not in seen and a["value"] is not None:
                seen.add(name)
                assert a == b, html
