"""The crawl: its bound, its second try, its log."""

import pytest
from test_ingest import item

from folioscan.plans.crawl import CLOSED, NO_THUMBNAILS, OPEN, crawl
from folioscan.plans.ingest import ItemOptions
from folioscan.sources.logs import read_run_log, run_durations, run_metadata
from folioscan.sources.tables import TABLES, read_table
from folioscan.sources.workspace import new_folder, written

HOST = "http://h"
SITE = ItemOptions(base_url=HOST)


def list_page(number, links, end=None):
    pager = f'<span class="end"><a href="?p={end}">end</a></span>' if end else ""
    items = "".join(f'<li><a href="/v.do?wrtSn={i}">x</a></li>' for i in links)
    return 10**9 + number, f"{HOST}/l?p={number}", f'<ul id="wrtList">{items}</ul>{pager}'


def archive_of(spark, lists):
    items = [(i, f"{HOST}/v.do?wrtSn={i}", item(hero=f"/{i}.png")) for i in range(1001, 1009)]
    return spark.createDataFrame([*lists, *items], "page_id long, url string, html string")


def ids(spark, root):
    return sorted(r["_id"] for r in read_table(spark, root, "items").collect())


@pytest.mark.parametrize(
    "ends, stop, found",
    [
        ({1: 2}, 2, ["1001", "1002"]),
        ({1: 2, 2: 4}, 4, ["1001", "1002", "1003", "1004"]),  # page 2 knows more than page 1
        ({1: 3, 2: 2, 3: 5, 5: 5}, 5, ["1001", "1002", "1003", "1004", "1005"]),
        ({}, 1, ["1001"]),  # no pager
    ],
)
def test_the_pagers_bound_the_crawl(spark, ends, stop, found):
    archive = archive_of(spark, [list_page(n, [1000 + n], ends.get(n)) for n in range(1, 7)])
    root = new_folder(spark, "t")
    crawl(archive, root, 1, None, f"{HOST}/l?p=", SITE)
    assert ids(spark, root) == found
    assert dict(run_metadata(read_run_log(spark, f"{root}/log")).collect())["END_PAGE"] == str(stop)


def test_retry_and_replay(spark):
    archive = archive_of(spark, [list_page(1, range(1001, 1005), 1)])
    held = [(f"{HOST}/l/by.png", b"icon"), (f"{HOST}/1001.png", b"a"), (f"{HOST}/1002.png", None)]
    late = [*held[:2], (f"{HOST}/1002.png", b"b"), (f"{HOST}/1003.png", b"c")]
    first, second = (written(spark.createDataFrame(rows, "url string, payload binary"), "held") for rows in (held, late))
    root, ticks = new_folder(spark, "t"), []

    def clock():
        ticks.append(len(ticks) % 3)
        return 1_700_000_000.0 + 2.5 * ticks[-1]

    options = ItemOptions(base_url=HOST, thumbnail_files=True)

    def run():
        crawl(archive, root, 1, None, f"{HOST}/l?p=", options, first, 7, "r", True, second, clock)
        tables = {
            name: sorted(map(repr, read_table(spark, root, name).collect())) for name in TABLES if not name.endswith("files")
        }
        return tables, sorted(map(repr, read_run_log(spark, f"{root}/log").collect()))

    tables, log = run()
    assert ids(spark, root) == ["1001", "1002", "1003"]
    tried = {(r["line"], r["attempt"]): r["outcome"] for r in read_table(spark, root, "attempts").collect()}
    lost = [f"{i} : image not found" for i in (1002, 1003, 1004)]
    want = {(line, 1): OPEN for line in lost} | {(line, 2): CLOSED for line in lost[:2]} | {(lost[2], 2): OPEN}
    assert tried == want
    assert sum("image not found" in line for line in log) == 4 and any(NO_THUMBNAILS in line for line in log)
    times = run_durations(read_run_log(spark, f"{root}/log")).collect()
    assert sorted((r["run"], r["batch_id"], r["name"], r["seconds"]) for r in times) == [("r", 7, "END", 2.5), ("r", 7, "Total progress time", 2.5)]
    headers = dict(run_metadata(read_run_log(spark, f"{root}/log")).collect())
    assert headers["Run at"] == "2023-11-14_221320" and headers["Progress"] == "1 ~ 1 page(s)"
    # The same run and batch again leaves everything as it is.
    assert run() == (tables, log)


def test_list_pages_are_spread_before_they_are_parsed(spark, monkeypatch):
    """A narrow table may make many pages: they are parsed by all cores, not by the few splits of its file."""
    from folioscan.plans import crawl as plans
    from folioscan.plans.rendering import PART_SITE
    from folioscan.sources.workspace import new_folder, written

    tasks, parse = [], plans.parse_pages

    def counted(pages, *args, **options):
        tasks.append(pages.rdd.getNumPartitions())
        return parse(pages, *args, **options)

    monkeypatch.setattr(plans, "parse_pages", counted)
    pages = [(i, f"https://h/list.do?p={i}", '<ul id="wrtList"><li><a href="/view.do?wrtSn=1">x</a></li></ul>') for i in range(3)]
    archive = written(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), "archive")
    _, parsed, stop = plans.read_lists(archive, 0, 2, "https://h/list.do?p=", PART_SITE, new_folder(spark, "owner"))
    assert tasks == [spark.sparkContext.defaultParallelism]
    assert stop == 2 and sorted(r["page_id"] for r in parsed.collect()) == [0, 1, 2]
