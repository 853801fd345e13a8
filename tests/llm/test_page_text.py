import html
import random
import re
import time
from math import e, log

import pytest

from folioscan.llm.page_text import Page, article_nodes, densities, extract_text, page_text

MIDDLE = "/root/testdata/sf0.01"


def article(page):
    """The article element without markup, read with patterns."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?(b|a)( [^>]*)?>", "", body)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_all_pages(spark):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages, ["page_id", "url"]).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


PARAGRAPHS = "<p>The first paragraph is long enough, it has &lt;marks&gt;.</p><p>So is the\n second one, with <i>in</i>line text.</p>"
TEXT = "The first paragraph is long enough, it has <marks>. So is the second one, with inline text."


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div id=main><a href=/>Home</a> <a href=/b>Back</a></div><div>{PARAGRAPHS}</div><div><a href=c>More</a></div>",
        f"<body><header><h1>Site</h1></header><div class='content'>{PARAGRAPHS}<div class='comment-list'><p>{'x ' * 90}</p></div></div>",
        f"<article>{PARAGRAPHS}<aside>{'a ' * 90}</aside><form>Search <input></form><script>if (a<b) x='</p>'</script></article>",
        f"<body><nav>{'Menu ' * 50}</nav><main>{PARAGRAPHS}</main><div class='cookie notice'>{'We use ' * 40}</div><footer>(c)</footer>",
        f"<BODY><DIV CLASS=sidebar><p>{'news ' * 80}</p></DIV><DIV>{PARAGRAPHS.upper().lower()}</DIV>".replace("the first", "The first").replace("so is", "So is"),
        PARAGRAPHS.replace("</p>", ""),
    ],
)
def test_layouts(page):
    assert page_text(page) == TEXT


SIDE = f"<div class='sidebar'><p>{'news ' * 15}</p></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='content with-sidebar'>{PARAGRAPHS}{SIDE}</div><div><a href=c>More</a></div>",
        f"<body><div class='page has-menu'><nav>{'Menu ' * 50}</nav><div class='post share-enabled'>{PARAGRAPHS}</div></div>",
        f"<body><div id=has-menu>{PARAGRAPHS}</div><div class=comments>{'I say ' * 90}</div>",
        f"<article><div class='post share-enabled'>{PARAGRAPHS}</div><div class=share>Share this</div></article>",
        f"<body><form action=/><div class='search'>Search</div><div>{PARAGRAPHS}</div></form></body>",
        f"<body><form action=/><div class='layout sidebar-right'><article>{PARAGRAPHS}</article>{SIDE}</div></form>",
        f"<body><div class='sidebar-layout'><main>{PARAGRAPHS}</main><aside>{'a ' * 90}</aside></div>",
        f"<body><div class='related'><article>Other</article></div><div class='nav-layout'><article>{PARAGRAPHS}</article></div>",
        f"<body><article>{PARAGRAPHS}</article><div class='page comments'>{'I say ' * 90}</div>",
        f"<body><div>{PARAGRAPHS}</div><div id=comments><article class=comment>I say so</article></div>",
        f"<body><div class='page has-menu' hidden>{'h ' * 90}</div><div>{PARAGRAPHS}</div>",
        f"<body><div class='sidebar-layout'>{PARAGRAPHS}</div></body>",
    ],
)
def test_marked_wrappers(page):
    assert page_text(page) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a b"),
        ("<script>x", ""), ("<!-- c", ""), ("a <b", "a"), ("</div></p>x", "x"), ("<article>x</article>", "x"),
        ("<ul><li>a<li>b</ul>", "a b"), ("1 < 2", "1 < 2"), ("<body hidden><p>y</p>", "y"),
    ],
)
def test_small_and_broken_pages(page, text):
    assert page_text(page) == text


def test_links_lower_the_density():
    page = Page("<body><div><a href=x>many words of a link here</a></div><div>many words of a text here, no link</div></body>")
    density, _ = densities(page)
    divs = [density[i] for i, tag in enumerate(page.tag) if tag == "div"]
    assert divs[0] < divs[1]


def test_broken_markup_takes_linear_time():
    for page in ("<p><b>" * 20_000, "<div>" * 20_000 + "x", "<" * 50_000, "<a href='" * 20_000, "</i>" * 30_000, "&" * 50_000):
        page_text(page)


def test_awkward_rows(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (None, None, "<p>x</p>", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = extract_text(pages, ["page_id", "url"]).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("", 0), ("x", 1)]
    assert extract_text(pages.limit(0), ["page_id", "url"]).count() == 0


def test_nested_wrappers_take_linear_time():
    page = "<form class='page has-menu'>" * 2_000 + "x" + "<div class=sidebar>y</div>" * 2_000
    assert page_text(page).startswith("x")


@pytest.mark.parametrize(
    "shape",
    [
        lambda n: "<div>" * n,
        lambda n: "<div>" * n + "<p>x" * n,
        lambda n: "<ul><li>" * n,
        lambda n: "<div>" * n + "</span2>" * n,
        lambda n: "<div><i>" * n + "</i></p>" * n,
        lambda n: "<div><b>y</b>" * n,
        lambda n: "<a href='x>" * n,
        lambda n: "<a " * n + "'",
        lambda n: "<a " + "b='" * n + ">",
        lambda n: "<a =\"'" * n,
    ],
)
def test_time_grows_with_the_page(shape):
    """Eight times the page takes far less than the 64 times of the square."""

    def seconds(n):
        times = []
        for _ in range(3):
            start = time.process_time()
            page_text(shape(n))
            times.append(time.process_time() - start)
        return min(times)

    assert seconds(32_000) < 24 * max(seconds(4_000), 0.004)


def test_density_of_random_trees():
    """Densities, their sums and the chosen subtree, counted anew for every node, without ``article`` or ``main``."""
    rng = random.Random(5)
    for _ in range(300):
        words = lambda: "word " * rng.randint(1, 30)

        def tree(depth):
            inner = "".join(tree(depth - 1) for _ in range(rng.randint(1, 4))) if depth else words()
            return f"<a href=x>{words()}</a>" if rng.random() < 0.15 else f"<div>{inner}</div>"

        page = Page(f"<html><body>{tree(4)}{tree(3)}{tree(2)}</body></html>")
        n = len(page.tag)
        below = [{i} for i in range(n)]
        for i in range(n - 1, 0, -1):
            below[page.parent[i]] |= below[i]
        linked = set().union(*(below[i] for i in range(n) if page.tag[i] == "a"))

        def chars(nodes):
            return sum(len(" ".join(piece.split())) for node, piece in page.pieces if piece and node in nodes)

        ratio = chars(linked) / chars(below[0])
        want = []
        for i in range(n):
            c, lc = chars(below[i]), chars(below[i] & linked)
            t, lt = len(below[i]) - 1, sum(page.tag[k] == "a" for k in below[i] - {i})
            if not c:
                want.append(0.0)
                continue
            base = log(c / max(c - lc, 1) * lc + ratio * c + e)
            raw = log(max(c * max(t, 1) / (max(lc, 1) * max(lt, 1)), 1.0)) / max(log(base + 1), 0.1)
            want.append(c / max(t, 1) * max(raw, 0.0))
        density, total = densities(page)
        sums = [sum(want[k] for k in range(1, n) if page.parent[k] == i) for i in range(n)]
        assert density == pytest.approx(want) and total == pytest.approx(sums)
        best = max(range(n), key=lambda i: (total[i] or density[i], i))
        path, node = {best}, best
        while page.tag[node] != "body" and node:
            node = page.parent[node]
            path.add(node)
        threshold = min(density[node] for node in path)
        beside = {i for i in range(1, n) if page.parent[i] in path - {best} and i not in path and density[i] >= threshold}
        assert article_nodes(page) == {best} | beside
