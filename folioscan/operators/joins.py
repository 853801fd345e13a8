"""Catalogue joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.operators.bitmap import whole_number, with_keys
from folioscan.sources.workspace import checkpointed

# Dimension rows a task can hold comfortably; above it the join shuffles, hot keys split.
BROADCAST_ROWS = 200_000
# Fact rows of one key that one task may get in a shuffled join.
ROWS_PER_SPLIT = 1_000_000
# Payload bytes that a broadcast dimension may hold.
BROADCAST_BYTES = 64 << 20


def not_broadcast(rows: DataFrame) -> DataFrame:
    """Rows of a join that nobody counted: both sides are sorted, whatever Spark takes their size for.

    Its estimates are bytes of packed files, or a product with an empty side. A million short rows pass there for a few MB, and
    the driver would hold them all as a hash table of a hundred.
    """
    return rows.hint("merge")


def hot_key_join(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Shuffled join to a table with one row per key, where a key may hold a third of the facts.

    Keys with more than ``rows_per_split`` facts, null among them, are cut into that many splits by the
    hash of ``spread_by``, and only their rows in ``other`` are repeated, once per split. There are at most
    ``facts / rows_per_split`` such keys, so their list is small enough to broadcast. ``facts`` is
    read twice; pass a stored table when computing it is expensive.
    """
    counts = facts.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    splits = F.ceil(F.col("n") / F.lit(rows_per_split))
    hot = counts.filter(F.col("n") > rows_per_split).select("hot_key", splits.cast("bigint").alias("splits"))
    places = F.coalesce("splits", F.lit(1)).cast("bigint")
    cut = facts.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("hot_key")), "left").drop("hot_key")
    cut = cut.withColumn("split", F.pmod(F.xxhash64(*spread_by), places))
    every = F.sequence(F.lit(0).cast("bigint"), places - 1)
    copies = other.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").drop("hot_key")
    copies = copies.withColumn("split", F.explode(every))
    return cut.drop("splits").join(not_broadcast(copies.drop("splits")), [key, "split"], how).drop("split")


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
    payload: str | None = None,
) -> DataFrame:
    """Facts to a narrow dimension with one row per key.

    The dimension is counted first (only its key is read), and so are the bytes of its ``payload``
    column, if it has one. Up to ``broadcast_rows`` and ``BROADCAST_BYTES`` it is broadcast and the
    facts stay where they are; beyond either both sides shuffle, hot keys split.
    """
    size = F.lit(0) if payload is None else F.coalesce(F.sum(F.octet_length(payload)), F.lit(0))
    rows, held = dimension.agg(F.count("*"), size).first()
    if rows <= broadcast_rows and held <= BROADCAST_BYTES:
        return facts.join(F.broadcast(dimension), key, how)
    return hot_key_join(facts, dimension, key, spread_by, how, rows_per_split)


# Long keys that fit a broadcast: some 30 MB as a hash table, and as much again while the driver builds and sends it.
BROADCAST_KEYS = 500_000


def keep_marked(rows: DataFrame, marks: DataFrame, key: str, kept: Column, limit: int | None = None) -> DataFrame:
    """Wide ``rows`` whose key ``marks`` keeps. ``key`` is a long that is unique on both sides.

    ``marks`` has one narrow row per row. The kept and the other keys are counted; the smaller set is
    broadcast, as a semi or an anti join, as keys up to ``limit`` (``BROADCAST_KEYS``) and as bitmaps beyond. The
    wide rows stay where they are.
    """
    limit = BROADCAST_KEYS if limit is None else limit
    counted = marks.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("other")).first()
    inside = counted["kept"] <= counted["other"]
    keys = marks.filter(kept if inside else ~kept).select(key)
    if min(counted) <= limit:
        return rows.join(F.broadcast(keys), key, "left_semi" if inside else "left_anti")
    return with_keys(rows, keys, key, inside)


def having_key(rows: DataFrame, keys: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Wide ``rows`` whose key is among ``keys`` (narrow, distinct). Keys are counted: up to ``limit``
    (``BROADCAST_KEYS``) they are broadcast, beyond that whole numbers are, as bitmaps, and the wide rows stay where
    they are. Only other keys make both sides shuffle.
    """
    limit = BROADCAST_KEYS if limit is None else limit
    keys = checkpointed(keys.select(key))
    if keys.count() <= limit:
        return rows.join(F.broadcast(keys), key, "left_semi")
    if whole_number(rows, key) and whole_number(keys, key):
        return with_keys(rows, keys, key)
    return rows.join(not_broadcast(keys), key, "left_semi")


def license_for_item(items: DataFrame, licenses: DataFrame, item_id: str = "_id", **options) -> DataFrame:
    """Every item with the stored licence it names (items whose licence is not stored drop out)."""
    stored = licenses.select(
        "license", F.col("license_name").alias("stored_name"), F.col("hash_").alias("hashlicense")
    )
    narrow = items.select(item_id, "license")
    joined = dimension_join(narrow, stored, "license", [item_id], payload="hashlicense", **options)
    return joined.select(
        item_id, F.col("license").alias("id"), F.col("stored_name").alias("license_name"), "hashlicense"
    )


def enrich_with_info(assets: DataFrame, items: DataFrame, key: str = "_id", info: str = "info") -> DataFrame:
    """Each asset with its item row as a struct; null when there is none, and the asset stays.

    One left join in place of a lookup per asset.
    """
    packed = items.select(key, F.struct(*items.columns).alias(info))
    return assets.join(packed, key, "left")


def catalogue_audit(assets: DataFrame, items: DataFrame, key: str = "_id") -> DataFrame:
    """``(key, problem)``: assets without an item and items without an asset.

    Both sides fold to distinct keys first; one full join then answers both directions from one
    shuffle of each side.
    """
    left = assets.select(key).distinct().withColumn("has_asset", F.lit(True))
    right = items.select(key).distinct().withColumn("has_item", F.lit(True))
    both = left.join(right, key, "full")
    problem = F.when(F.col("has_item").isNull(), F.lit("asset_without_item")).when(
        F.col("has_asset").isNull(), F.lit("item_without_asset")
    )
    return both.select(key, problem.alias("problem")).filter(F.col("problem").isNotNull())
