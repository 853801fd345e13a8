"""Counts and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.text import round3


def data_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("count"))


def batch_manifest(spark: SparkSession, start: int, pages: int, batches: int) -> DataFrame:
    """``(batch, first_page, pages)``: contiguous batches, the remainder goes to the last one."""
    size = pages // batches
    batch = F.col("id")
    last = pages - size * (batches - 1)
    return spark.range(batches).select(
        batch.alias("batch"),
        (F.lit(start) + batch * size).alias("first_page"),
        F.when(batch == batches - 1, F.lit(last)).otherwise(F.lit(size)).cast("bigint").alias("pages"),
    )


def batch_of(page, start: int, pages: int, batches: int):
    """The batch a page belongs to: arithmetic, so no range join with the manifest."""
    size = pages // batches
    last = F.lit(batches - 1).cast("bigint")
    if size == 0:
        return last
    return F.least(F.floor((page - F.lit(start)) / F.lit(size)), last)


def progress(done: DataFrame, page: str, start: int, pages: int, batches: int) -> DataFrame:
    """``(batch, done, pages, percent)`` per batch, also for a batch without a finished page."""
    counted = done.groupBy(batch_of(F.col(page), start, pages, batches).alias("batch")).agg(F.count("*").alias("done"))
    manifest = batch_manifest(done.sparkSession, start, pages, batches).drop("first_page")
    share = round3(F.lit(100.0) * F.col("done") / F.nullif(F.col("pages"), F.lit(0)))
    joined = manifest.join(counted, "batch", "left").na.fill(0, ["done"])
    return joined.select("batch", "done", "pages", F.coalesce(share, F.lit(100.0)).alias("percent"))
