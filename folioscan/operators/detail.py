"""Detail tables: long rows, label mapping and the fixed wide schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.attributes import (
    COLUMNS,
    attribute_of,
    detail_value,
    dictionary,
)
from folioscan.functions.text import normalise_label


def detail_rows(parsed: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """``(keys.., pos, title, value, links)``, one row per table row, as found on the page."""
    return parsed.select(*keys, F.inline("detail"))


def map_attributes(rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Adds ``attribute`` (null for an unknown label) and the cleaned ``value``.

    ``labels`` is the dictionary table; its 26 rows are broadcast. Rows keep their place, so this
    adds no shuffle.
    """
    labels = dictionary(rows.sparkSession) if labels is None else labels
    cleaned = rows.withColumn("value", detail_value(F.col("title"), F.col("value"), F.col("links")))
    keyed = cleaned.withColumn("label", normalise_label(F.col("title")))
    return keyed.join(F.broadcast(labels), "label", "left").drop("label")


def to_wide(rows: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Long mapped rows to one row per key: 26 attribute columns and ``col_size``.

    For rows that are already spread over the cluster. The value list is explicit, so no job runs to
    find it; partial aggregation folds a hot key before the one shuffle. Of a repeated label the
    first by position wins. Parsed pages go through ``widen`` instead, without a shuffle.
    """
    wide = [
        F.expr(f"min_by(value, pos) FILTER (WHERE attribute = '{c}') AS {c}") for c in COLUMNS
    ]
    filled = " + ".join(f"max(int(attribute <=> '{c}'))" for c in COLUMNS)
    return rows.groupBy(*keys).agg(*wide, F.expr(f"{filled} AS col_size"))


def with_names(parsed: DataFrame) -> DataFrame:
    """Adds ``names`` and ``values``: item column (null: unknown) and cleaned value of each row.

    Two arrays beside ``detail``, computed once per page; everything below looks places up in them.
    """
    names = F.transform("detail", lambda row: attribute_of(row["title"]))
    values = F.transform("detail", lambda row: detail_value(row["title"], row["value"], row["links"]))
    return parsed.withColumns({"names": names, "values": values})


def wide_columns() -> list[Column]:
    """26 attribute columns and ``col_size`` from ``names`` and ``values``, without a shuffle.

    ``array_position`` finds the first row of an attribute, so a repeated label changes nothing.
    """
    wide = [F.expr(f"get(values, int(array_position(names, '{c}')) - 1) AS {c}") for c in COLUMNS]
    filled = " + ".join(f"int(array_position(names, '{c}') > 0)" for c in COLUMNS)
    return [*wide, F.expr(f"{filled} AS col_size")]


def repeated_attributes() -> Column:
    """Attributes of rows that fill a column an earlier row has filled already."""
    names = F.col("names")
    return F.filter(names, lambda name, i: name.isNotNull() & (F.array_position(names, name) != i + 1))


def broken_at() -> Column:
    """Place of the first row without a label cell, or with a known label and no value cell.

    Labels are looked up for rows without a value only, which are rare.
    """
    broken = F.transform(
        "detail",
        lambda row, i: F.when(
            row["title"].isNull() | (row["value"].isNull() & attribute_of(row["title"]).isNotNull()), i
        ),
    )
    return F.array_min(broken)


def unknown_titles(broken: Column) -> Column:
    """Labels outside the dictionary, up to the first broken row, where reading a page ends."""
    names = F.col("names")
    known_end = F.coalesce(broken, F.size("detail"))
    rows = F.filter(
        "detail", lambda row, i: F.get(names, i).isNull() & row["title"].isNotNull() & (i < known_end)
    )
    return F.transform(rows, lambda row: row["title"])


def whole_tables(parsed: DataFrame) -> DataFrame:
    """Pages that have a detail table without a broken row."""
    return parsed.filter(F.col("detail").isNotNull() & broken_at().isNull())


def widen(parsed: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """One wide row per parsed page with a whole detail table. No shuffle: a page is one row."""
    return with_names(whole_tables(parsed)).select(*keys, *wide_columns())
