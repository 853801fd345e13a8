"""First writer wins: primary-key semantics on distributed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.operators.joins import not_broadcast

# Keys are compared as one struct, in which nulls are equal, under this name.
_KEY = "_key"


def _as_key(key: Sequence[str]) -> Column:
    return F.struct(*key).alias(_KEY)


def _fold(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``(_key, _first)``: per key the smallest row by ``order``, ties broken by the other columns."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    if not rest and len(order) == 1:
        # A plain minimum aggregates in a hash table; a struct would be sorted first.
        least = rows.groupBy(_as_key(key)).agg(F.min(order[0]).alias(order[0]))
        return least.select(_KEY, F.struct(*order).alias("_first"))
    return rows.groupBy(_as_key(key)).agg(F.min(F.struct(*order, *rest)).alias("_first"))


def _unstored(keyed: DataFrame, existing: DataFrame, key: Sequence[str], small: bool) -> DataFrame:
    """Rows whose ``_key`` is not stored; stored keys fold first, however often one is repeated."""
    stored = existing.select(_as_key(key))
    if small:
        stored = stored.join(F.broadcast(keyed.select(_KEY)), _KEY, "left_semi")
    return keyed.join(not_broadcast(stored.distinct()), _KEY, "left_anti")


def first_by_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by the other columns. Nulls are equal.

    An aggregate with a map-side partial, not a window: a key that holds a third of all rows
    shrinks to one row per task before the shuffle. Keep large payloads out of ``rows`` and join
    them afterwards on the order column.
    """
    return _fold(rows, key, order).select(f"{_KEY}.*", "_first.*").select(*rows.columns)


def absent(rows: DataFrame, existing: DataFrame, key: Sequence[str], small: bool = False) -> DataFrame:
    """Rows whose key is not stored yet. Nulls are equal.

    Say ``small`` when the caller has counted ``rows`` and they fit a broadcast: the store is then
    scanned against them in place, and only its few matching keys take part in the anti join. A
    store that keeps growing is never shuffled for a small batch.
    """
    return _unstored(rows.withColumn(_KEY, _as_key(key)), existing, key, small).drop(_KEY)


def insert_if_absent(
    new: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[str], small: bool = False
) -> DataFrame:
    """Rows of ``new`` to append: the first of each key, unless the key is stored already.

    The fold comes before the anti join, so that join never meets a hot key, and it leaves the rows
    partitioned as the join needs them: one shuffle serves both. ``small`` as in ``absent``.
    """
    kept = _unstored(_fold(new, key, order), existing, key, small)
    return kept.select(f"{_KEY}.*", "_first.*").select(*new.columns)


def license_dimension(rows: DataFrame, license: str = "license", order: Sequence[str] = ("page_id",)) -> DataFrame:
    """Distinct licences, one row per licence file, first seen wins."""
    return first_by_key(rows.filter(F.col(license).isNotNull()), [license], order)
