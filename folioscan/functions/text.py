"""Text cleaning and small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points a Unicode-aware strip removes at both ends.
STRIP_CODE_POINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
STRIP_CHARS = "".join(map(chr, STRIP_CODE_POINTS))

# Fixed value: the run label, as in 2024-01-31_235959.
RUN_LABEL_FORMAT = "yyyy-MM-dd_HHmmss"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` removes ASCII blanks only)."""
    return F.trim(text, F.lit(STRIP_CHARS))


def clean_value(text: Column) -> Column:
    """Detail value: strip first, then delete line breaks, tabs and double quotes.

    The order matters: blanks that sit inside quotes survive.
    """
    return F.translate(strip(text), '\n\r\t"', "")


def clean_license_text(text: Column) -> Column:
    """Licence text: delete line breaks and tabs first, then strip; quotes stay."""
    return strip(F.translate(text, "\n\r\t", ""))


def normalise_label(label: Column) -> Column:
    """Remove ASCII blanks only, so a tab or line break keeps a label unknown."""
    return F.translate(label, " ", "")


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """First regex match, or null (``regexp_extract`` alone gives an empty string)."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def to_integer(text: Column) -> Column:
    """Scraped text to long; null instead of an ANSI cast error."""
    return text.try_cast("bigint")


def join_authors(names: Column) -> Column:
    """Every name followed by a comma, the last one too; no names give an empty string."""
    return F.concat_ws("", F.transform(names, lambda name: F.concat(name, F.lit(","))))


def key_label(name: Column) -> Column:
    return F.upper(name)


def round3(number: Column) -> Column:
    return F.round(number, 3)


def run_label(started_at: Column) -> Column:
    return F.date_format(started_at, RUN_LABEL_FORMAT)


def json_object(*columns: Column | str, keep_nulls: bool = True) -> Column:
    """The row as a JSON object. Nulls are written out, as an API client expects every key."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*columns), options)
