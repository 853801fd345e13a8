"""Error routing, outcomes and the retry pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.attributes import UNKNOWN_LABEL
from folioscan.functions.text import first_match
from folioscan.functions.urls import CODE_WIDTH, ITEM_PATH, NO_CODE, item_url
from folioscan.operators.joins import dimension_join, having_key

# Outcomes of an item.
INSERTED, MISSING, DUPLICATE, ERROR = "inserted", "missing_structure", "duplicate", "error"

# Formats and messages of log lines.
ITEM_LINE = "%s : %s"
PAGE_LINE = "PAGE_URL_ERROR : %s/%s"
LICENSE_LINE = "LICENSE IMAGE ERROR: %s"
THUMBNAIL_LINE = "THUMBNAIL ERROR: %s"
THUMBNAIL_MESSAGE = "thumbnail not made"
IMAGE_MESSAGE = "Origin image hash data save error"
HEADER_MARK = ">"


def item_error_line(item_id: Column, message: Column) -> Column:
    return F.format_string(ITEM_LINE, item_id, message)


def page_error_line(message: Column, url: Column) -> Column:
    return F.format_string(PAGE_LINE, message, url)


def license_error_line(name: Column) -> Column:
    return F.format_string(LICENSE_LINE, name)


def thumbnail_error_line(name: Column) -> Column:
    return F.format_string(THUMBNAIL_LINE, name)


def classify_outcome(complete: Column, failed: Column, first: Column) -> Column:
    """Outcome of an item from three flags: parts complete, hard failure, first writer of its id.

    Events on a page come in this order: a missing part ends it silently, then a failure is
    logged, then a stored id is left alone. Logged side errors do not change the outcome.
    """
    return (
        F.when(~complete, F.lit(MISSING))
        .when(failed, F.lit(ERROR))
        .when(first, F.lit(INSERTED))
        .otherwise(F.lit(DUPLICATE))
    )


def unknown_attribute_rows(rows: DataFrame, item_id: str = "_id", keys: Sequence[str] = ()) -> DataFrame:
    """``(keys.., item_id, pos, title, line)`` for mapped detail rows with an unknown label."""
    line = item_error_line(F.col(item_id), F.lit(UNKNOWN_LABEL))
    return rows.filter(F.col("attribute").isNull()).select(*keys, item_id, "pos", "title", line.alias("line"))


def status_summary(outcomes: DataFrame, status: str = "status") -> DataFrame:
    return outcomes.groupBy(status).agg(F.count("*").alias("items"))


def log_item_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log lines that name an item: no header mark in front, digits at the start."""
    text = F.col(column)
    return lines.filter(~text.startswith(HEADER_MARK) & text.rlike("^[0-9]"))


def retry_candidates(
    lines: DataFrame, column: str = "value", path: str = ITEM_PATH, digits: int = CODE_WIDTH[1]
) -> DataFrame:
    """``(item_id, url)`` of the items to try again, each once.

    The id is taken at its full width; page, licence and thumbnail lines name no item and drop out.
    """
    item_id = first_match(F.col(column), f"^[0-9]{{1,{digits}}}")
    ids = log_item_lines(lines, column).select(item_id.alias("item_id")).distinct()
    return ids.select("item_id", item_url(F.col("item_id"), path).alias("url"))


def retry_pass(
    lines: DataFrame,
    archive: DataFrame,
    code: Column,
    column: str = "value",
    order: str = "page_id",
    path: str = ITEM_PATH,
) -> DataFrame:
    """Archive pages of the items a log names, ready for one more item pass.

    ``code`` computes the item id of an archive row. Ids are matched on narrow rows first, where
    pages without an id leave at once and an id with very many copies is split; the HTML is then picked
    by the unique ``order`` column, whose hits are counted, so that the pages stay where they are.
    """
    wanted = retry_candidates(lines, column, path).select("item_id")
    coded = archive.select(order, code.alias("item_id")).filter(F.col("item_id") != NO_CODE)
    hits = dimension_join(coded, wanted, "item_id", [order]).select(order).distinct()
    return having_key(archive, hits, order)
