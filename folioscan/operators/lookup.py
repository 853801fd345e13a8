"""Point lookups and the key/value view of an item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.payload import encode_base64
from folioscan.functions.text import json_object, key_label
from folioscan.operators.first_writer import first_by_key
from folioscan.operators.joins import having_key
from folioscan.operators.paging import data_range, page_slice
from folioscan.sources.workspace import checkpointed

# Fixed value: the answer for an id that is not stored.
EMPTY_OBJECT = "{}"


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """The row with this key, or no row. The equality reaches the parquet scan."""
    return table.filter(F.col(key) == F.lit(value)).limit(1)


def lookup_json(wanted: DataFrame, table: DataFrame, key: str, columns: Sequence[Column | str]) -> DataFrame:
    """``(key, answer)`` for every wanted key: the row as JSON, ``{}`` when it is not stored.

    One answer per key: of rows stored under one key the smallest counts. The stored rows are picked
    where they lie when the wanted keys are few (they are counted); JSON is made of the picked rows only.
    """
    keys = checkpointed(wanted.select(key).distinct())
    found = having_key(table, keys, key)
    found = first_by_key(found, [key], []) if len(table.columns) > 1 else found.distinct()
    answers = found.select(key, json_object(*columns).alias("answer"))
    joined = keys.join(answers, key, "left")
    return joined.select(key, F.coalesce("answer", F.lit(EMPTY_OBJECT)).alias("answer"))


def renamed(names: dict[str, str]) -> list[Column]:
    """Answer columns of an asset or licence table; the payload ``hash_`` as base64."""
    return [(encode_base64(F.col(old)) if old == "hash_" else F.col(old)).alias(new) for old, new in names.items()]


def page_answer(rows: DataFrame, order: str, start: int | None, count: int | None, info: DataFrame | None = None) -> DataFrame:
    """One ``answer`` for a page of a table: ``{"list": [..]}`` with ``count`` rows from ``start``, by ``order``.

    ``order`` names a row. With ``info`` every row carries that table's row of its key as ``info``. A
    missing bound gives an empty list.
    """
    rows = page_slice(rows, order, start, count) if info is None else data_range(rows, info, order, start, count)
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.struct(*rows.columns).alias("row")))),
        lambda entry: entry["row"],
    )
    return rows.agg(json_object(listed.alias("list")).alias("answer"))


def select_rename(table: DataFrame, names: dict[str, str]) -> DataFrame:
    """Column subset under new names, stored name -> answer name."""
    return table.select(*[F.col(old).alias(new) for old, new in names.items()])


# Answer names of the asset and licence lookups.
IMAGE_NAMES = {"_id": "id", "filename": "filename", "hash_": "hashimg"}
THUMBNAIL_NAMES = {"_id": "id", "filename": "filename", "hash_": "hashthumbnail"}
LICENSE_NAMES = {"license_name": "licensename", "license": "filename"}
LICENSE_IMAGE_NAMES = {"license": "id", "license_name": "license_name", "hash_": "hashlicense"}


def non_empty_attributes(table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``(key, KEY, value)`` lines of the truthy values: nulls, empty texts and number 0 drop out.

    The text ``"0"`` is truthy and stays, so numbers are tested before they become text.
    """
    texts = dict(table.dtypes)
    shown = []
    for name in columns:
        value = F.col(name)
        empty = value == F.lit("") if texts[name] == "string" else value == F.lit(0)
        shown.append(F.when(~empty, value.cast("string")).alias(name))
    lines = table.select(key, *shown).unpivot([key], list(columns), "name", "value")
    return lines.filter(F.col("value").isNotNull()).select(key, key_label(F.col("name")).alias("KEY"), "value")
