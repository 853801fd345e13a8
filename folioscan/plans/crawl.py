"""The crawl over an archive: list pages, their links, the item pages behind them, the catalogue, a second try."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import first_match
from folioscan.functions.urls import CODE_WIDTH
from folioscan.operators.errors import log_item_lines
from folioscan.operators.joins import not_broadcast
from folioscan.operators.links import extract_links, frontier_errors, last_page, link_errors, max_page
from folioscan.operators.page_parse import parse_pages
from folioscan.plans.ingest import BATCH_RUN, ItemOptions, ingest_batch, reingest
from folioscan.sources.logs import named_line, setting_line, write_run_log
from folioscan.sources.pages import list_frontier, pages_of, resolve_frontier, spread
from folioscan.sources.tables import read_batch, write_batch
from folioscan.sources.workspace import written

# What became of an error line after the second try, and the log's warning about thumbnails.
CLOSED, OPEN = "closed", "open"
NO_THUMBNAILS = "Warning: Original image will not download. Can't create thumbnail image"


def _misses(resolved: DataFrame) -> DataFrame:
    """Error rows of the frontier's missing pages, each once."""
    lines = frontier_errors(resolved).select("line").distinct()
    return lines.select(F.lit(None).cast("bigint").alias("page_id"), F.lit("not archived").alias("message"), "line")


def read_lists(
    archive: DataFrame, start: int, stop: int | None, template: str, options: ItemOptions, owner: str
) -> tuple[DataFrame, DataFrame, int]:
    """``(frontier, parsed, stop)``: the list pages from ``start`` on, stored, each read once.

    Without a ``stop`` the pagers bound the frontier: the first page's says how far it goes, and pages up to there
    may say that it goes further, until none does. A first page without a pager is the only one.
    """
    spark, frontier, parsed = archive.sparkSession, [], []
    low, high = start, start if stop is None else stop
    while True:
        lists = resolve_frontier(list_frontier(spark, low, high, template), archive)
        lists = written(lists.select("url", "page_id", "status"), f"lists-{len(frontier)}", owner)
        pages = parse_pages(spread(pages_of(lists, archive)), ["links", "pager"], selectors=options.selectors)
        pages = written(pages, f"links-{len(frontier)}", owner)
        frontier.append(lists)
        parsed.append(pages)
        bound = max_page(last_page(pages)).first()["max_page"] if stop is None else None
        if bound is None or bound <= high:
            return reduce(DataFrame.unionByName, frontier), reduce(DataFrame.unionByName, parsed), high
        low, high = high + 1, bound


def attempts(first: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """``(item_id, line, attempt, outcome)`` of the error lines that name an item, by its id as the line has it.

    The first try leaves a line open; it is closed when the second try, if there was one, logs it no more.
    """
    item_id = first_match(F.col("line"), f"^[0-9]{{1,{CODE_WIDTH[1]}}}")
    lines = log_item_lines(first.select("line").distinct(), "line").select(item_id.alias("item_id"), "line")
    tried = lines.select("*", F.lit(1).alias("attempt"), F.lit(OPEN).alias("outcome"))
    if again is None:
        return tried
    still = again.select("line").distinct().withColumn("still", F.lit(True))
    outcome = F.when(F.col("still"), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    retried = lines.join(not_broadcast(still), "line", "left").select("item_id", "line", F.lit(2).alias("attempt"), outcome.alias("outcome"))
    return tried.unionByName(retried)


def crawl(
    archive: DataFrame,
    root: str,
    start: int,
    stop: int | None,
    template: str,
    options: ItemOptions = ItemOptions(),
    assets: DataFrame | None = None,
    batch_id: int = 0,
    run: str = BATCH_RUN,
    retry: bool = False,
    later_assets: DataFrame | None = None,
    clock: Callable[[], float] = time.time,
) -> None:
    """Read the list pages ``start .. stop`` and add the items they link to to the catalogue below ``root``.

    Without ``stop`` the pagers say where the lists end. Links and errors are narrow and are stored once; HTML is
    picked from the archive where it lies. Pages that are missing or have no usable links go to the error table,
    with the item errors. With ``retry`` the items that the errors name go through the item pass once more, as
    the run ``<run>-retry``, against ``later_assets`` if the asset archive has grown meanwhile; the table
    ``attempts`` says which lines that closed. The log of the run and batch, with its settings, page range, times
    and all error lines, is a folder below ``root``. The same run and batch again replaces all of this.
    """
    spark, began = archive.sparkSession, clock()
    owner = f"{root}#{run}"
    lists, parsed, stop = read_lists(archive, start, stop, template, options, owner)
    links = extract_links(parsed, options.base_url).filter(F.col("link").isNotNull())
    items = resolve_frontier(links.select(F.col("link").alias("url")).distinct(), archive)
    items = written(items.select("url", "page_id", "status"), "items", owner)
    unusable = link_errors(parsed).select("page_id", F.lit("no usable links").alias("message"), "line")
    errors = unusable.unionByName(_misses(lists)).unionByName(_misses(items))
    ingest_batch(pages_of(items, archive), batch_id, root, options, assets, run, errors)
    logged = read_batch(spark, root, "errors", batch_id, run).select("line")
    ended, again = clock(), None
    if retry:
        second = f"{run}-retry"
        tried = assets if later_assets is None else later_assets
        reingest(logged.select(F.col("line").alias("value")), archive, batch_id, root, options, tried, second)
        again = read_batch(spark, root, "errors", batch_id, second).select("line")
    write_batch(attempts(logged, again), root, "attempts", batch_id, run)

    lines = [named_line("Run at", time.strftime("%Y-%m-%d_%H%M%S", time.gmtime(began)))]
    if options.thumbnail_files and not options.origin_files:
        lines.append(f"> {NO_THUMBNAILS}")
    settings = {"START_PAGE": start, "END_PAGE": stop, "BASE_URL": options.base_url}
    lines += [setting_line(key, value) for key, value in settings.items()]
    lines += [named_line("Progress", f"{start} ~ {stop} page(s)"), named_line("Total progress time", f"{round(ended - began, 3)} sec")]
    if retry:
        lines.append(named_line("END", f"{round(clock() - ended, 3)} sec"))
    write_run_log(lines, logged if again is None else logged.unionByName(again), f"{root}/log", run, batch_id)
