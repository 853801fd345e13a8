"""Names for added columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def free_names(rows: DataFrame, names: Iterable[str]) -> dict[str, str]:
    """For each name one that none of the table's columns has, by underscores in front."""
    used, out = {c.lower() for c in rows.columns}, {}
    for name in names:
        free = name
        while free.lower() in used:
            free = f"_{free}"
        used.add(free.lower())
        out[name] = free
    return out


def quoted(columns: Iterable[str]) -> list[str]:
    """Column names as they stand, dots and backticks in them included."""
    return ["`" + name.replace("`", "``") + "`" for name in columns]


def filtered_in_arrow(rows: DataFrame, function: Callable) -> DataFrame:
    """``mapInArrow`` that returns some of the rows. Names with dots, which it cannot take, are put aside."""
    plain = [f"c{i}" for i in range(len(rows.columns))]
    schema = T.StructType([T.StructField(n, f.dataType, f.nullable) for n, f in zip(plain, rows.schema)])
    return rows.toDF(*plain).mapInArrow(function, schema).toDF(*rows.columns)
