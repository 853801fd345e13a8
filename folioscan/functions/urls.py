"""URL pieces: item codes, page numbers, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscan.functions.text import to_integer

# The id parameter of an item URL, its width, and the id of a URL without one.
CODE_KEY = "wrtSn="
CODE_WIDTH = (4, 16)
NO_CODE = "error"

# Where originals go and the name an item's image gets.
ORIGIN_DIR = "../../img/origin/"
ASSET_SUFFIX = ".png"

# The detail path of an item; the site's own prefix is passed by the caller.
ITEM_PATH = "/view.do?wrtSn=%s&menuNo=200023"


def item_code(url: Column, key: str = CODE_KEY, width: tuple[int, int] = CODE_WIDTH) -> Column:
    """Digits after the first ``key`` that is followed by enough of them, else ``error``.

    ``key`` is a regex fragment and matches anywhere. ASCII digits only.
    """
    low, high = width
    code = F.regexp_extract(url, f"(?:{key})([0-9]{{{low},{high}}})", 1)
    return F.coalesce(F.nullif(code, F.lit("")), F.lit(NO_CODE))


def trailing_number(href: Column, max_digits: int = 10) -> Column:
    """The number a link ends in; of a longer run the last ``max_digits``; null without one."""
    return to_integer(F.regexp_extract(href, f"([0-9]{{1,{max_digits}}})$", 1))


def absolute_url(base: Column | str, href: Column) -> Column:
    """Plain concatenation, no RFC resolution; a null link stays null."""
    return F.concat(F.lit(base) if isinstance(base, str) else base, href)


def list_url(template: str, page: Column) -> Column:
    return F.concat(F.lit(template), page.cast("string"))


def item_url(item_id: Column, path: str = ITEM_PATH) -> Column:
    return F.format_string(path, item_id)


def asset_name(item_id: Column) -> Column:
    return F.concat(item_id, F.lit(ASSET_SUFFIX))


def asset_path(item_id: Column, directory: str = ORIGIN_DIR) -> Column:
    """Set whether or not a file is saved there."""
    return F.concat(F.lit(directory), asset_name(item_id))


def basename(src: Column) -> Column:
    """Last path segment; a query string belongs to it."""
    return F.element_at(F.split(src, "/"), -1)
