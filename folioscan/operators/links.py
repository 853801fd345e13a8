"""List pages: item links, the last page number, and the page errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.urls import absolute_url, trailing_number
from folioscan.operators.errors import page_error_line


def extract_links(parsed: DataFrame, base: Column | str = "", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``(keys.., pos, href, link)``, one row per link in page order, duplicates kept.

    ``link`` is ``base`` and ``href`` put together; ``base`` may be a column of ``parsed``. Pages
    without a usable list yield no row here and one in ``link_errors``.
    """
    prefix = F.lit(base) if isinstance(base, str) else base
    exploded = parsed.select(*keys, prefix.alias("base"), F.posexplode("links").alias("pos", "href"))
    return exploded.select(*keys, "pos", "href", absolute_url(F.col("base"), F.col("href")).alias("link"))


def link_errors(parsed: DataFrame, url: str = "url", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``(keys.., line)`` for every list page that could not be read, and for every null link."""
    broken = F.when(F.col("links").isNull(), F.lit("no usable link list"))
    null_link = F.when(F.exists("links", lambda href: href.isNull()), F.lit("link without address"))
    message = F.coalesce(broken, null_link)
    return parsed.filter(message.isNotNull()).select(*keys, page_error_line(message, F.col(url)).alias("line"))


def last_page(parsed: DataFrame, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``(keys.., last_page)``: the number the pager's link ends in, null without one."""
    return parsed.select(*keys, trailing_number(F.col("pager_href")).alias("last_page"))


def max_page(last_pages: DataFrame) -> DataFrame:
    """The bound of the frontier over a whole corpus."""
    return last_pages.agg(F.max("last_page").alias("max_page"))


def frontier_errors(resolved: DataFrame, url: str = "url") -> DataFrame:
    """The frontier rows no archived page serves, with their error ``line``."""
    line = page_error_line(F.lit("not archived"), F.col(url)).alias("line")
    return resolved.filter(F.col("status") == "miss").select("*", line)
