"""Stable paging: slices, pages and whole-table page numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscan.operators.joins import enrich_with_info
from folioscan.sources.workspace import checkpointed, estimated_bytes

# Fixed value: items on one page.
PAGE_SIZE = 9
# Offsets up to here use a plain top-k; deeper slices rank the keys over range partitions.
SHALLOW_ROWS = 10_000
# Rows that one task ranks; they are counted where Spark estimates more than these bytes a task.
RANK_ROWS_PER_TASK, RANK_BYTES_PER_TASK = 2_000_000, 64 << 20
# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33


def _sortable(rows: DataFrame) -> list[str]:
    """Columns that Spark can order by: all but maps and what holds them."""
    return [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]


def slice_rows(
    rows: DataFrame, order: Sequence[str], start: int | None, count: int | None, shallow: int | None = None
) -> DataFrame:
    """``count`` rows from offset ``start``, in order; a missing bound gives no rows.

    One order holds for every offset: by ``order``, ties by the other columns, nulls first. Shallow
    slices (up to ``shallow`` rows deep) compile to one top-k, where each task keeps
    ``start + count`` rows. That grows with the offset, so deeper ones rank the rows over range
    partitions (``with_rank``) and keep the wanted ranks. Ranked rows are stored once: for wide rows
    slice the keys and join the rest, as ``page_slice`` does.
    """
    if start is None or count is None:
        return rows.limit(0)
    order = [*order, *[c for c in _sortable(rows) if c not in order]]
    if start + count <= (SHALLOW_ROWS if shallow is None else shallow):
        return rows.orderBy(*order).offset(start).limit(count)
    ranked = with_rank(rows, order, carry=[c for c in rows.columns if c not in order])
    wanted = ranked.filter((F.col("rank") >= start) & (F.col("rank") < start + count))
    return wanted.orderBy("rank").select(*rows.columns)


def with_rank(
    rows: DataFrame, order: Sequence[str], partitions: int | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """``(order.., carry.., rank)``: the 0-based place of every row in the whole table's order.

    Rows that agree in all of ``order`` are numbered one after the other. Only these columns are
    sorted, in range partitions; a global window would put every row in one task. The sorted rows are
    checkpointed, so the counts per partition and the places within them come from the same
    partitioning even when executors are lost in between. The running total spans one row per partition.
    """
    order, kept = list(order), [*order, *carry]
    spark = rows.sparkSession
    keys = rows.select(*kept)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # An estimate of a join is a product of its sides, so a large one is only a reason to count.
        if estimated_bytes(keys) > partitions * RANK_BYTES_PER_TASK:
            partitions = max(partitions, -(-keys.count() // RANK_ROWS_PER_TASK))
    ranged = keys.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = checkpointed(ranged.withColumn("mark", F.monotonically_increasing_id()))
    part = F.shiftright("mark", _PLACE_BITS)
    place = F.col("mark").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = placed.select(*kept, part.alias("part"), place.alias("place"))
    joined = numbered.join(F.broadcast(offsets), "part")
    return joined.select(*kept, (F.col("before") + F.col("place")).alias("rank"))


def assign_pages(rows: DataFrame, order: Sequence[str], size: int = PAGE_SIZE) -> DataFrame:
    """``(order.., page, slot)`` for every row: its 1-based page and its 0-based place there."""
    ranked = with_rank(rows, order)
    page = F.expr(f"rank div {int(size)} + 1")
    return ranked.select(*order, page.alias("page"), F.pmod("rank", F.lit(size)).alias("slot"))


def page(rows: DataFrame, order: Sequence[str], number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (from 1)."""
    return slice_rows(rows, order, (number - 1) * size, size)


def page_count(total: Column, size: int = PAGE_SIZE) -> Column:
    """Pages needed for ``total`` rows; none for an empty table."""
    return F.ceil(total / F.lit(size)).cast("bigint")


def first_row(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.orderBy(*order).limit(1)


def _slice_keys(payloads: DataFrame, key: str, start: int, count: int) -> tuple[DataFrame, Column]:
    """The keys of a slice as ``_key``, computed once, and a condition that bounds any scan for them.

    The keys of a slice are neighbours in key order, so two values, the smallest and the largest,
    are enough for parquet filters that skip row groups. A null key counts as one.
    """
    keys = checkpointed(slice_rows(payloads.select(key), [key], start, count).select(F.col(key).alias("_key")))
    low, high, nulls = keys.agg(F.min("_key"), F.max("_key"), F.count_if(F.col("_key").isNull())).first()
    near = F.col(key).between(F.lit(low), F.lit(high))
    return F.broadcast(keys) if count <= SHALLOW_ROWS else keys, near | F.col(key).isNull() if nulls else near


def _having(rows: DataFrame, keys: DataFrame, key: str, near: Column) -> DataFrame:
    return rows.filter(near).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def page_slice(payloads: DataFrame, key: str, start: int | None, count: int | None) -> DataFrame:
    """A slice of a table with wide payloads, in key order: keys first, payloads after. ``key`` names a row.

    The key side is at most ``count`` rows and is broadcast when that is small.
    """
    if start is None or count is None:
        return payloads.limit(0)
    return _having(payloads, *_bounded(payloads, key, start, count)).orderBy(key)


def _bounded(payloads: DataFrame, key: str, start: int, count: int) -> tuple[DataFrame, str, Column]:
    keys, near = _slice_keys(payloads, key, start, count)
    return keys, key, near


def data_range(payloads: DataFrame, items: DataFrame, key: str, start: int | None, count: int | None) -> DataFrame:
    """A page slice with the item row of each asset as a struct, null when there is none.

    The item rows of the slice are picked first, under the same bounds, so the left join meets a
    slice on both sides and not the item table.
    """
    if start is None or count is None:
        return enrich_with_info(payloads.limit(0), items, key)
    bounds = _bounded(payloads, key, start, count)
    return enrich_with_info(_having(payloads, *bounds), _having(items, *bounds), key)
